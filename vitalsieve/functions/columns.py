"""Column expressions and whole-frame projections used by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def quoted(name: str) -> str:
    """Column reference for any header, with spaces, brackets, dots or colons."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def tall(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), as_type: str = "double") -> DataFrame:
    """Wide to tall: (keep..., feature, value). Only the named columns are read."""
    clash = {"feature", "value"} & {*columns, *keep}
    if clash:
        raise ValueError(f"rename columns {sorted(clash)} before reshaping")
    kept = [f"_k{i}" for i in range(len(keep))]
    wide = df.select(*[col(k).alias(a) for k, a in zip(keep, kept)], *[col(c).cast(as_type).alias(c) for c in columns])
    long = wide.unpivot([F.col(a) for a in kept], [col(c) for c in columns], "feature", "value")
    return long.select(*[F.col(a).alias(k) for k, a in zip(keep, kept)], "feature", "value")


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Column names by kind: ``numeric`` or ``other``."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return numeric if kind == "numeric" else [c for c in df.columns if c not in numeric]


def computed_once(df: DataFrame, **values: Column) -> DataFrame:
    """Add columns that are evaluated once per row, however often later expressions and filters refer to them.

    The one-element ``explode`` keeps the optimizer from copying a large expression into each of its users.
    """
    packed = F.struct(*[v.alias(n) for n, v in values.items()])
    held = df.select(*[col(c) for c in df.columns if c not in values], F.explode(F.array(packed)).alias("_once"))
    return held.select(*[col(c) for c in held.columns if c != "_once"], *[F.col("_once")[n].alias(n) for n in values])


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often and in whatever lambdas it is referred to."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def normalise_headers(df: DataFrame) -> DataFrame:
    """Trim, replace spaces by underscores, lower-case. Two headers that meet are an error."""
    names = [c.strip().replace(" ", "_").lower() for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"Duplicate column names detected after normalization: {names}")
    return df.toDF(*names)


def drop_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    present = set(df.columns)
    return df.drop(*[n for n in names if n in present])


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column. NULL stays NULL."""
    return df.select(
        *[F.trim(col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else col(f.name) for f in df.schema.fields]
    )


def tokens_to_null(df: DataFrame, tokens: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Text tokens such as ``N/A`` become NULL."""
    names = set(columns) if columns is not None else {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[F.when(~F.trim(col(c)).isin(*tokens), col(c)).alias(c) if c in names else col(c) for c in df.columns]
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    floating = (T.DoubleType, T.FloatType)
    return df.select(
        *[F.when(~F.isnan(col(f.name)), col(f.name)).alias(f.name) if isinstance(f.dataType, floating) else col(f.name)
          for f in df.schema.fields]
    )


def folded(value: Column) -> Column:
    """Case and space folding for label look-ups."""
    return F.upper(F.trim(value.cast("string")))


def recode(value: Column, codes: Mapping[str, object], strict: bool = True, what: str = "value") -> Column:
    """Folded text to code. An unmapped text is an error when ``strict``, else NULL; NULL stays NULL."""
    table = F.create_map(*[x for k, v in codes.items() for x in (F.lit(str(k).strip().upper()), F.lit(v))])
    code = table[folded(value)]
    if not strict:
        return code
    message = F.concat(F.lit(f"Unexpected {what}: "), value.cast("string"))
    return F.when(value.isNotNull() & code.isNull(), F.raise_error(message)).otherwise(code)


def decode(code: Column, labels: Mapping[object, str], default: str) -> Column:
    """Code to label, ``default`` for codes outside the map."""
    table = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(table[code], F.lit(default))


def zeros_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A zero in these columns means the measurement was not taken."""
    hit = set(columns)
    return df.select(*[F.nullif(col(c), F.lit(0)).alias(c) if c in hit else col(c) for c in df.columns])


def lenient_number(value: Column) -> Column:
    """Text to double, NULL where it is not a number."""
    return value.try_cast("double")


def positive_flag(value: Column, positive: object) -> Column:
    return (value == F.lit(positive)).cast("int")


def subject_id(df: DataFrame, id_col: str, out: str = "subject_id") -> DataFrame:
    """Subject code ``S<digits>`` inside the id; if any row has none, text before the last underscore for all rows."""
    coded = F.nullif(F.regexp_extract(col(id_col).cast("string"), r"(S\d+)", 1), F.lit(""))
    stem = F.regexp_replace(col(id_col).cast("string"), r"_[^_]*$", "")
    any_missing = df.agg(F.coalesce(F.max(coded.isNull()), F.lit(False))).scalar()
    return df.withColumn(out, F.when(any_missing, stem).otherwise(coded))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole)


def feature_slice(values: Column, start: int, length: int) -> Column:
    """Named group of features by position in an array column (1-based start)."""
    return F.slice(values, start, length)


def content_hash(columns: Sequence[Column]) -> Column:
    """Hash of several values that tells NULL from text and one value from the next."""
    parts = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat_ws(",", *parts), 256)


def _written(value: Column, kind: T.DataType) -> Column:
    """A value as text that no other value of its type has: zeros have no sign, elements of collections keep apart, maps have no order."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(value == 0, F.lit("0.0")).otherwise(value.cast("string"))
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, T.MapType):
        entries = T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)]))
        return F.array_join(F.array_sort(F.transform(F.map_entries(value), lambda x: _held(x, entries.elementType))), "")
    if isinstance(kind, T.ArrayType):
        return F.array_join(F.transform(value, lambda x: _held(x, kind.elementType)), "")
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.concat(*[_held(value[f.name], f.dataType) for f in kind.fields]))
    return value.cast("string")


def _held(value: Column, kind: T.DataType) -> Column:
    text = _written(value, kind)
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """Hash of these columns of ``df``, equal for rows that are equal and for no others: by type, NULL apart from everything."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return F.sha2(F.concat(F.lit(""), *[_held(col(c), kinds[c]) for c in columns]), 256)
