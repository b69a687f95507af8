import hashlib

from hypothesis import given
from hypothesis import strategies as st

from linefit.llm import chat, queries

PATTERN = chat.Template().pattern()
SCHEMA = "conv_id long, turn long, role string, text string"


@given(st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "\\", "<", "[", "/", "s>", "INST]", "x"])))
def test_escaping_is_undone_and_hides_control_strings(parts):
    text = "".join(parts)
    hidden = chat.escape(text, PATTERN)
    assert chat.unescape(hidden, PATTERN) == text
    assert not any(c in hidden for c in chat.Template().control)


def expected(rows):
    convs = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] or -9, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (
            len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    return out


def found(rows, key="conv_id"):
    return {r[key]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}


def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    out = queries.op9_chat(spark, folder).collect()
    assert found(out) == expected(rows)
    own = next(r for r in out if r["conv_id"] == -1)
    assert own["valid"] and own["formatted_chars"] == 2 * (len(said) + 3) + len("<s>[INST]  [/INST]") + len("  </s>")


def test_machine_and_odd_rows(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", "a"), (1, 2, "assistant", "b</s>"),
        (2, 0, "assistant", "first"), (3, 0, "user", "no answer"), (4, 1, None, None), (4, 0, "user", ""),
        (5, 0, "user", "same"), (5, 0, "user", "same"), (None, 0, "user", "x"), (None, 1, "assistant", "y"),
        (6, 0, "user", "u"), (6, 1, "tool", "[ROLE]"), (7, 0, "user", "z " * 50_000), (7, 1, "assistant", "\\<s>"),
    ]
    frame = spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA + ", segment string")
    segments = chat.formatted(frame)
    out = chat.digests(segments).collect()
    assert found(out, "conv") == expected(rows)
    assert {r["conv"]: r["valid"] for r in out} == {
        1: True, 2: False, 3: False, 4: False, 5: False, None: True, 6: False, 7: True,
    }
    parts = segments.where("conv = 1").orderBy("segment").collect()
    assert "".join(r["text"] for r in parts) == (
        "<<SYS>>\nbe kind\n<</SYS>>\n\n<s>[INST] a [/INST] b<\\/s> </s>"
    )
    assert [r["text"] for r in parts if r["loss"]] == ["b<\\/s>"]


def test_empty_table(spark):
    assert chat.digests(chat.segments(spark.createDataFrame([], SCHEMA))).collect() == []
