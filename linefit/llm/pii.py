"""Personal data replaced by keyed surrogates of the same kind, in DataFrame expressions only.

Found: e-mail addresses, phone, social security and (by their check digit) card numbers, IPv4
addresses, access keys, tokens and passwords that a text assigns, and names that follow a title
or begin with a well-known given name. A surrogate keeps the format: digits stay digits,
vowels vowels of their script, upper case upper case; cards keep issuer and a valid check
digit, phones their country code, addresses their top-level domain (below a reserved name),
names their title, gender, script and Slavic surname ending.

A surrogate depends on the secret and the entity alone, so an entity has the same one in every
document and in each of its spellings (``coreference``), and no text is joined or shuffled for
it. Distinct entities are then collected and their surrogates checked: one that equals another
surrogate, or an entity that occurs, is derived anew; only documents with such an entity take
part in a join. Given names come from closed lists by a permutation, so they stay distinct, but
may equal a name that occurs elsewhere.

Null text stays null; rows without entities pass unchanged; rows and columns are all kept, whatever
their names (the count's name may not be taken). Null keys, repeated rows, empty tables and texts
of any length are fine. If a kind has no room left for another surrogate (a table with nearly all
social security numbers), the job ends with an error that names it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linefit.llm.common import discard, named, row_of, staged, unpacked

#: Distinct entities whose surrogates one task draws and checks, about.
ENTITIES = 2_000
#: Surrogates an entity tries before the job ends with an error: a kind may run out of numbers.
ATTEMPTS = 200

# Given names by script and gender.
GIVEN = {
    "latin_f": ["Anna", "Charlotte", "Claudia", "Elizabeth", "Emily", "Françoise", "Gabriela",
                "Hannah", "Isabella", "Jennifer", "Katharina", "Lucía", "Margaret", "Patricia",
                "Sophie", "Victoria"],
    "latin_m": ["Alexander", "Benjamin", "Christopher", "Diego", "François", "Friedrich",
                "Heinrich", "James", "Javier", "Joseph", "Michael", "Nicolás", "Robert", "Thomas",
                "Wilhelm", "William"],
    "cyrillic_f": ["Анастасия", "Екатерина", "Елена", "Ирина", "Мария", "Наталья", "Ольга", "Татьяна"],
    "cyrillic_m": ["Александр", "Алексей", "Дмитрий", "Иван", "Михаил", "Николай", "Сергей", "Юрий"],
    "greek_f": ["Αικατερίνη", "Βασιλική", "Ελένη", "Μαρία", "Σοφία"],
    "greek_m": ["Αλέξανδρος", "Γεώργιος", "Δημήτριος", "Κωνσταντίνος", "Νικόλαος"],
}
# Titles that a name follows.
TITLES = ["Mr.", "Mrs.", "Ms.", "Dr.", "Prof.", "Herr", "Frau", "Señor", "Señora", "Monsieur",
          "Madame", "г-н", "г-жа"]
# Characters of a kind, and those that replace them.
KINDS = [
    ("[0-9]", "0123456789"),
    ("[aeiouyàáâãäåæèéêëìíîïòóôõöøœùúûüÿ]", "aeiou"),
    ("[AEIOUYÀÁÂÃÄÅÆÈÉÊËÌÍÎÏÒÓÔÕÖØŒÙÚÛÜŸ]", "AEIOU"),
    ("[\\p{IsLatin}&&\\p{Ll}]", "bcdfghklmnprstvz"),
    ("[\\p{IsLatin}&&\\p{Lu}]", "BCDFGHKLMNPRSTVZ"),
    ("[аеёиоуыэюя]", "аеиоу"), ("[АЕЁИОУЫЭЮЯ]", "АЕИОУ"),
    ("[\\p{IsCyrillic}&&\\p{Ll}]", "бвгдзклмнпрст"), ("[\\p{IsCyrillic}&&\\p{Lu}]", "БВГДЗКЛМНПРСТ"),
    ("[αεηιουωάέήίόύώ]", "αεηιο"), ("[ΑΕΗΙΟΥΩΆΈΉΊΌΎΏ]", "ΑΕΗΙΟ"),
    ("[\\p{IsGreek}&&\\p{Ll}]", "βγδκλμνπρτ"), ("[\\p{IsGreek}&&\\p{Lu}]", "ΒΓΔΚΛΜΝΠΡΤ"),
]
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_CAPITAL = "\\p{Lu}[\\p{L}'’-]+"
_GIVEN = "|".join(n for names in GIVEN.values() for n in names)
_TITLE = "|".join(t.replace(".", "\\.") for t in TITLES)
# Each alternative begins with what rules it out soonest, as it is tried at every character.
_NAME = (
    "(?=[\\p{Lu}г])(?<![\\p{L}.-])"
    f"(?:(?:{_TITLE}) {_CAPITAL}(?: {_CAPITAL})?|(?:{_GIVEN})(?: {_CAPITAL}){{1,2}})"
)
_EMAIL = "[\\w.%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
_IPV4 = f"(?:{_OCTET}\\.){{3}}{_OCTET}"
_CARD = "[3-6][0-9]{3}(?:[0-9]{9,15}|(?:[ -][0-9]{4}){2}[ -][0-9]{1,7})"
_SSN = "[0-9]{3}-[0-9]{2}-[0-9]{4}"
_PHONE = (
    "(?:\\+[0-9]{1,3}[ .-]?)?(?:\\([0-9]{2,4}\\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
    "|\\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}"
)
_NUMBER = (
    f"(?=[0-9+(])(?:(?<![\\w.]){_IPV4}(?!\\w|\\.[0-9])|(?<![\\w-]){_CARD}(?![\\w-])"
    f"|(?<![\\w-]){_SSN}(?![\\w-])|(?<![\\w+])(?:{_PHONE})(?!\\w))"
)
_KEY = "AKIA[0-9A-Z]{16}"
_SECRET = "(?<=[=\"])(?<=(?i:password|token|secret)\\s?=\\s?\"?)[^\\s\"',;]{8,}"
PATTERN = f"{_NUMBER}|(?<!\\w){_KEY}(?!\\w)|{_SECRET}|{_NAME}|(?<![\\w.%+-]){_EMAIL}"


def _hint(text: Column) -> Column:
    """False only for texts without an entity; much cheaper than the pattern.

    An address has a sign of its own; of numbers only an IP address may have no two digits side by
    side, and it has digits about a stop; a key and a secret have their words, in any case.
    """
    lower = F.lower(text)
    out = text.contains("@") | text.rlike("[0-9]\\.?[0-9]") | text.contains("AKIA")
    for word in ("password", "token", "secret"):
        out = out | lower.contains(word)
    return out | text.rlike(_NAME)


def _luhn(digits: Column) -> Column:
    """Sum of a number's digits with every second one, from the last but one, doubled."""
    twice = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    places = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.when(
            (F.length(digits) - i) % 2 == 1, twice(F.substring(digits, i, F.lit(1)).cast("int"))
        ).otherwise(F.substring(digits, i, F.lit(1)).cast("int")),
    )
    return F.aggregate(places, F.lit(0), lambda a, b: a + b)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _kind(match: Column) -> Column:
    """Which entity a match is; null for a number that is no card after all."""
    out = F.when(match.rlike(f"^{_EMAIL}$"), "email")
    out = out.when(match.rlike(f"^{_IPV4}$"), "ipv4")
    out = out.when(
        match.rlike(f"^{_CARD}$"),
        F.when(_luhn(_digits(match)) % 10 == 0, "card"),
    )
    out = out.when(match.rlike(f"^{_SSN}$"), "ssn")
    out = out.when(match.rlike("^\\+?[0-9 .()-]+$") & (F.length(_digits(match)) >= 7), "phone")
    out = out.when(match.rlike(f"^{_KEY}$"), "key")
    return out.when(match.rlike(f"^(?:(?:{_TITLE}) |(?:{_GIVEN}) )\\p{{Lu}}"), "name").otherwise("secret")


def _country(phone: Column) -> Column:
    """The prefix of a phone number that stays."""
    return F.regexp_extract(phone, "^\\+[0-9]{1,3}(?=[ .(-])[ .-]?", 0)


def _part_kind(part: Column) -> Column:
    out = F.when(part.isin(TITLES), "title")
    for kind, names in GIVEN.items():
        out = out.when(part.isin(names), f"given_{kind}")
    return out.otherwise("surname")


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _units(match: Column) -> Column:
    """(kind, raw) of what has a surrogate of its own: a match, or each word of a name."""
    unit = lambda k, r: F.struct(k.alias("kind"), r.alias("raw"))
    return _let(
        _kind(match),
        lambda kind: F.when(
            kind == "name", F.transform(F.split(match, " "), lambda p: unit(_part_kind(p), p))
        ).otherwise(F.array(unit(kind, match))),
    )


def _norm(kind: Column, raw: Column) -> Column:
    """What spellings of one entity have in common."""
    phone = _digits(F.substring(raw, F.length(_country(raw)) + 1, F.length(raw)))
    return (
        F.when(kind == "phone", phone).when(kind.isin("card", "ssn"), _digits(raw))
        .when(kind.isin("email", "surname"), F.lower(raw)).otherwise(raw)
    )


def _pick(seed: Column, place: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(seed, place), F.lit(n)).cast("int")


def _letters(raw: Column, keep: Column, hexadecimal: Column, pick) -> Column:
    """``raw`` with every letter and digit but the first ``keep`` ones drawn anew in kind.

    ``pick(i, n)`` draws one of ``n`` for the character at ``i``.
    """
    def drawn(c, i):
        out = F.when(i <= keep, c).when(
            hexadecimal & c.rlike("[a-f]"), F.substring(F.lit("abcdef"), pick(i, 6) + 1, F.lit(1))
        )
        for pattern, alphabet in KINDS:
            chosen = F.substring(F.lit(alphabet), pick(i, len(alphabet)) + 1, F.lit(1))
            out = out.when(c.rlike(pattern), chosen)
        return out.otherwise(c)

    return F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.length(raw)), lambda i: drawn(F.substring(raw, i, F.lit(1)), i)
        ), "",
    )


def _laid_out(raw: Column, digits: Column) -> Column:
    """``digits`` in the places of the digits of ``raw``."""
    def char(i):
        c = F.substring(raw, i, F.lit(1))
        return F.when(
            c.rlike("[0-9]"),
            F.substring(digits, F.length(_digits(F.substring(raw, F.lit(1), i))), F.lit(1)),
        ).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(raw)), char), "")


def _given(secret: str) -> dict[str, str]:
    """Each given name's surrogate: its list is turned by a keyed step, so distinct names stay
    distinct and none stays as it is."""
    out = {}
    for kind, names in GIVEN.items():
        digest = hashlib.sha256(f"{secret}|{kind}".encode()).digest()
        turn = int.from_bytes(digest[:8], "big") % (len(names) - 1) + 1
        out |= {name: names[(i + turn) % len(names)] for i, name in enumerate(names)}
    return out


def surrogate(kind: Column, raw: Column, attempt: Column, secret: str) -> Column:
    """What replaces an entity written as ``raw``."""
    def seed(k, *of):
        return F.sha2(F.concat_ws("|", F.lit(secret), k, *of), 256)

    def number(e) -> Column:
        """As many digits as the entity has, laid out as its own."""
        norm, own = e["norm"], e["own"]
        drawn = F.transform(F.sequence(F.lit(2), F.length(norm)), lambda i: _pick(own, i, 10).cast("string"))
        first = F.when(kind == "card", F.substring(norm, 1, 1)).when(
            kind == "ssn", (_pick(own, F.lit(1), 8) + 1).cast("string")
        ).otherwise((_pick(own, F.lit(1), 8) + 2).cast("string"))
        digits = F.concat(first, F.array_join(drawn, ""))
        body = F.substring(digits, F.lit(1), F.length(digits) - 1)
        checked = F.concat(body, F.pmod(F.lit(10) - _luhn(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string"))
        country = F.when(kind == "phone", _country(raw)).otherwise("")
        rest = F.substring(raw, F.length(country) + 1, F.length(raw))
        return F.concat(country, _laid_out(rest, F.when(kind == "card", checked).otherwise(digits)))

    def spelled(e) -> Column:
        """Letters and digits drawn anew; an address's domain is drawn by itself."""
        cut = F.when(kind == "email", F.length(e["word"])).otherwise(1 << 20)
        at = F.when(kind == "email", F.concat(e["word"], F.lit("@"), F.substring_index(e["domain"], ".", 1)))
        top = F.regexp_extract(e["domain"], "(?i)\\.(com|net|org)$", 1)
        tail = F.when(kind == "email", F.concat(F.lit(".example."), F.when(top == "", "com").otherwise(top)))
        drawn = _letters(
            F.coalesce(at, e["word"]), F.when(kind == "key", 4).otherwise(0),
            (kind == "secret") & raw.rlike("^[0-9a-f]+$"),
            lambda i, n: _pick(F.when(i <= cut, e["own"]).otherwise(e["of_domain"]), F.when(i <= cut, i).otherwise(i - cut), n),
        )
        return F.concat(drawn, F.coalesce(tail, e["ending"]))

    octets = lambda e: F.array_join(
        F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (_pick(e["own"], i, 254) + 1).cast("string")), "."
    )
    # short forms may run out of surrogates, so later attempts are longer
    more = F.repeat(F.when(kind == "secret", "0").otherwise("x"), F.floor(attempt / 8).cast("int"))
    ending = F.when(
        kind == "surname", F.regexp_extract(raw, "(?:ов|ев|ин|ова|ева|ина|ский|ская)$", 0)
    ).otherwise("")
    word = F.when(kind == "email", F.substring_index(raw, "@", 1)).otherwise(
        F.substring(raw, F.lit(1), F.length(raw) - F.length(ending))
    )
    domain = F.substring_index(raw, "@", -1)
    norm = _norm(kind, raw)
    entity = F.struct(
        norm.alias("norm"), seed(kind, norm, attempt.cast("string")).alias("own"),
        F.when(kind == "key", word).otherwise(F.concat(word, more)).alias("word"), ending.alias("ending"),
        domain.alias("domain"), F.when(kind == "email", seed(F.lit("domain"), F.lower(domain))).alias("of_domain"),
    )
    given = F.create_map(*[F.lit(x) for pair in _given(secret).items() for x in pair])
    return F.when(kind.startswith("given_"), F.try_element_at(given, raw)).when(
        kind.isNull() | (kind == "title"), raw
    ).otherwise(
        _let(entity, lambda e: F.when(kind.isin("phone", "card", "ssn"), number(e))
             .when(kind == "ipv4", octets(e)).otherwise(spelled(e)))
    )


def _entity(kind: Column, norm: Column) -> Column:
    return F.concat_ws("|", kind, norm)


def _retries(units: DataFrame, secret: str) -> tuple[DataFrame | None, list[str]]:
    """(entity, attempt) of distinct entities whose first surrogate will not do."""
    checked = ~F.col("kind").startswith("given_") & (F.col("kind") != "title")
    entities, path = staged(
        units.where(checked & F.col("kind").isNotNull())
        .select("kind", _norm(F.col("kind"), F.col("raw")).alias("norm")).distinct(), "entities",
    )
    paths, attempt, settled, retried = [path], 0, None, None
    pending, left = entities, entities.count()
    real = entities.select("kind", F.col("norm").alias("s"))
    while True:
        drawn = surrogate(F.col("kind"), F.col("norm"), F.lit(attempt), secret)
        spread = pending.repartition(max(1, min(left // ENTITIES, 10_000)), "kind", "norm")
        tried = spread.withColumn("s", _norm(F.col("kind"), drawn))
        taken = real if settled is None else real.unionByName(settled.select("kind", "s"))
        clash = tried.join(taken.withColumn("clash", F.lit(True)).distinct(), ["kind", "s"], "left")
        nth = F.row_number().over(W.partitionBy("kind", "s").orderBy("norm"))
        judged, path = staged(
            clash.withColumn("ok", F.col("clash").isNull() & (nth == 1)).select("kind", "norm", "s", "ok"),
            "surrogates",
        )
        paths.append(path)
        won = judged.where("ok")
        settled = won if settled is None else settled.unionByName(won)
        if attempt:
            again = won.select(_entity(F.col("kind"), F.col("norm")).alias("entity"), F.lit(attempt).alias("attempt"))
            retried = again if retried is None else retried.unionByName(again)
        pending = judged.where(~F.col("ok")).select("kind", "norm")
        left = pending.count()
        if not left:
            return retried, paths
        attempt += 1
        if attempt == ATTEMPTS:
            kinds = sorted(r[0] for r in pending.select("kind").distinct().collect())
            raise ValueError(f"{left} entities found no surrogate of their own: no room left for {', '.join(kinds)}")


def replaced(
    docs: DataFrame, text: str = "text", key: str = "doc_id", secret: str = "change-me",
    count_as: str | None = None,
) -> DataFrame:
    """``docs`` with surrogates in ``text``, and the number of entities if ``count_as`` names it.

    ``secret`` must be kept: with it the surrogates can be told, not the entities.
    """
    columns = docs.columns
    if count_as in columns:
        raise ValueError(f"the table has a column {count_as!r}: give the count another name")
    body = F.col("text")
    found = F.when(_hint(body), F.regexp_extract_all(body, F.lit(PATTERN), F.lit(0)))
    rows = docs.select(
        row_of(docs, [c for c in columns if c != text]), named(text).alias("text"), named(key).alias("key")
    ).withColumn("found", found)
    units = rows.where(F.size("found") > 0).select(
        F.explode("found").alias("match")
    ).select(F.explode(_units(F.col("match"))).alias("u")).select("u.*").distinct()
    retries, paths = _retries(units, secret)
    if retries is None:
        attempt = lambda kind, raw: F.lit(0)
        discard(docs.sparkSession, *paths)
    else:
        mine = rows.where(F.size("found") > 0).select("key", F.explode("found").alias("match")).select(
            "key", F.explode(_units(F.col("match"))).alias("u")
        ).select("key", _entity(F.col("u.kind"), _norm(F.col("u.kind"), F.col("u.raw"))).alias("entity")
        ).distinct().join(retries, "entity")
        maps = mine.groupBy(F.col("key").alias("of")).agg(
            F.map_from_entries(F.collect_list(F.struct("entity", "attempt"))).alias("again")
        )
        rows = rows.join(maps, F.col("key").eqNullSafe(F.col("of")), "left")
        attempt = lambda kind, raw: F.coalesce(
            F.try_element_at(F.col("again"), _entity(kind, _norm(kind, raw))), F.lit(0)
        )

    def new(match: Column) -> Column:
        return F.array_join(
            F.transform(_units(match), lambda u: surrogate(u["kind"], u["raw"], attempt(u["kind"], u["raw"]), secret)),
            " ",
        )

    between = F.split(body, PATTERN, -1)
    stitched = F.array_join(
        F.zip_with(between, F.transform("found", new), lambda b, s: F.concat(b, F.coalesce(s, F.lit("")))), "",
    )
    number = F.coalesce(F.size(F.filter("found", lambda m: _kind(m).isNotNull())), F.lit(0))
    kept = unpacked(rows, columns, {text: F.when(F.size("found") > 0, stitched).otherwise(body)})
    if count_as:
        kept.append(F.when(F.size("found") > 0, number).otherwise(0).alias(count_as))
    return rows.select(*kept)
