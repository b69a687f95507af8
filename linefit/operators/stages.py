"""Feature preparation as pipeline stages.

Each stage is one native expression, so a chain of them collapses into a single projection
over the scan. Vectors are ``array<double>`` columns; :class:`ToMLVector` converts at the
border to MLlib. A stage that knows the width of its output says so in the column's metadata.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark import keyword_only
from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linefit.functions import fields as X
from linefit.functions import vectors as V


def _param(name: str, doc: str, convert) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=convert)


class _Stage(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """One input column, one output column."""

    _defaults: dict = {}

    def __init__(self, **params):
        super().__init__()
        self._setDefault(**self._defaults)
        self._set(**params)

    def setInputCol(self, value: str):
        return self._set(inputCol=value)

    def setOutputCol(self, value: str):
        return self._set(outputCol=value)

    def _expression(self, df: DataFrame) -> Column:
        raise NotImplementedError

    def _width(self, df: DataFrame) -> int | None:
        return None

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self._expression(df)
        width = self._width(df)
        if width is not None:
            out = out.alias(self.getOutputCol(), metadata=V.width_metadata(width))
        return df.withColumn(self.getOutputCol(), out)


class FieldSplitter(_Stage):
    """Line to its fields by position; every field keeps its place."""

    separator = _param("separator", "text between fields", TypeConverters.toString)
    first = _param("first", "fields to cut off, all if unset", TypeConverters.toInt)
    _defaults = {"separator": ","}

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, separator=",", first=None):
        super().__init__(**self._input_kwargs)

    def _expression(self, df):
        first = self.getOrDefault("first") if self.isSet("first") else None
        return X.split_fields(F.col(self.getInputCol()), self.getOrDefault("separator"), first)


class LineTokenizer(_Stage):
    """Line to lower-case tokens; tokens shorter than ``minTokenLength`` are dropped."""

    pattern = _param("pattern", "regular expression between tokens", TypeConverters.toString)
    minTokenLength = _param("minTokenLength", "shortest token kept", TypeConverters.toInt)
    toLowercase = _param("toLowercase", "whether to lower-case first", TypeConverters.toBoolean)
    _defaults = {"pattern": ",", "minTokenLength": 1, "toLowercase": True}

    @keyword_only
    def __init__(
        self, *, inputCol=None, outputCol=None, pattern=",", minTokenLength=1, toLowercase=True
    ):
        super().__init__(**self._input_kwargs)

    def _expression(self, df):
        return X.tokens(
            F.col(self.getInputCol()),
            self.getOrDefault("pattern"),
            self.getOrDefault("minTokenLength"),
            self.getOrDefault("toLowercase"),
        )


class ToNumbers(_Stage):
    """Array of texts to array of doubles; what is not a number becomes null.

    With ``indices`` only the elements at those positions are read and kept.
    """

    indices = _param("indices", "0-based positions, all if unset", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, indices=None):
        super().__init__(**self._input_kwargs)

    def _expression(self, df):
        texts = F.col(self.getInputCol())
        if not self.isSet("indices"):
            return X.to_doubles(texts)
        return F.array(*[X.to_double(X.field(texts, i)) for i in self.getOrDefault("indices")])

    def _width(self, df):
        return len(self.getOrDefault("indices")) if self.isSet("indices") else None


class VectorPicker(_Stage):
    """The elements of a vector at the given positions, in the given order."""

    indices = _param("indices", "0-based positions", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, indices=None):
        super().__init__(**self._input_kwargs)

    def _expression(self, df):
        return V.pick(V.as_array(df, self.getInputCol()), self.getOrDefault("indices"))

    def _width(self, df):
        return len(self.getOrDefault("indices"))


class FirstElement(_Stage):
    """One-element vector to number."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__(**self._input_kwargs)

    def _expression(self, df):
        return V.element(V.as_array(df, self.getInputCol()), 0)


class LabelShift(_Stage):
    """Number minus a constant."""

    offset = _param("offset", "constant to subtract", TypeConverters.toFloat)
    _defaults = {"offset": 0.0}

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, offset=0.0):
        super().__init__(**self._input_kwargs)

    def _expression(self, df):
        return F.col(self.getInputCol()) - F.lit(self.getOrDefault("offset"))


class MinimumLabelShift(
    Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Learns the smallest label; the fitted stage moves it to zero."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df):
        smallest = df.agg(F.min(self.getInputCol())).first()[0]
        if smallest is None:
            raise ValueError(f"column {self.getInputCol()!r} holds no value to shift by")
        return LabelShift(
            inputCol=self.getInputCol(), outputCol=self.getOutputCol(), offset=float(smallest)
        )


class ColumnFunction(_Stage):
    """Any function from column to column as a stage.

    The function builds an expression, so it stays inside generated code. A saved stage holds that
    expression as SQL text over the input column; loading parses it again, whatever the input
    column is called by then. ``inputType``, which a transformed table sets, is the type the text
    is written for. A function whose expression has no SQL text that gives it back, such as one
    around Python code or with a lambda of its own, cannot be saved.
    """

    INPUT = "column_function_input"  # stands for the input column in the text
    expression = _param("expression", "SQL text of the function over its input", TypeConverters.toString)
    inputType = _param("inputType", "type of the input column", TypeConverters.toString)
    _defaults = {"inputType": "double"}

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, function: Callable = None, inputType="double"):
        kwargs = dict(self._input_kwargs)
        self.function = kwargs.pop("function", None)
        super().__init__(**kwargs)

    def _expression(self, df):
        name = self.getInputCol()
        if self.function is None:
            if not self.isSet("expression"):
                raise ValueError("a ColumnFunction needs a function")
            text = self.getOrDefault("expression")
            return F.expr(re.sub(rf"\b{self.INPUT}\b", lambda _: f"`{name}`", text))
        self._set(inputType=df.schema[name].dataType.simpleString())
        return self.function(F.col(name))

    def sql_text(self) -> str:
        """The function's expression as SQL over ``INPUT``, checked by parsing it again."""
        if self.function is None:
            return self.getOrDefault("expression")
        spark = SparkSession.active()
        nothing = spark.createDataFrame([], f"{self.INPUT} {self.getOrDefault('inputType')}")
        wanted = nothing.select(self.function(F.col(self.INPUT)).alias("out"))
        plan = wanted._jdf.queryExecution().analyzed()
        text = plan.projectList().head().child().sql()
        try:
            same = nothing.select(F.expr(text).alias("out")).sameSemantics(wanted)
        except AnalysisException:
            same = False
        if not same:
            raise ValueError(f"the function of {self.uid} has no SQL text to be saved as: {text}")
        return text

    def write(self):
        self._set(expression=self.sql_text())
        return super().write()


class DegreeTwo(_Stage):
    """Polynomial terms of degree one and two, without the constant."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__(**self._input_kwargs)

    def _expression(self, df):
        name = self.getInputCol()
        return V.degree_two(V.as_array(df, name), V.known_width(df, name))

    def _width(self, df):
        width = V.known_width(df, self.getInputCol())
        return None if width is None else V.degree_two_width(width)


class ToMLVector(_Stage):
    """``array<double>`` to MLlib's vector type."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__(**self._input_kwargs)

    def _expression(self, df):
        return array_to_vector(F.col(self.getInputCol()))

    def _width(self, df):
        return V.known_width(df, self.getInputCol())


def stage_of(model, kind: type):
    """The first stage of a fitted pipeline that is a ``kind``."""
    for stage in model.stages:
        if isinstance(stage, kind):
            return stage
    raise LookupError(f"no {kind.__name__} among the stages")
