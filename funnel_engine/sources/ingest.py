"""Source scan and cleaning of the raw session table.

``read_sessions`` reads every field as text (no schema inference pass over the
data); ``clean_sessions`` coerces with ``try_*`` expressions, so bad values
become NULL / 0 instead of failing the job, exactly like the reference loader.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import flag_ci
from ..schema import FLAG_SOURCES, NULL_TOKENS, RAW_SCHEMA, SOURCE_PATH_ENV


def source_path(path: str | None = None) -> str:
    """Explicit path, else the environment override, else a local default."""
    if path:
        return str(path)
    return os.environ.get(SOURCE_PATH_ENV, "data/raw/sessions.csv")


def read_sessions(
    spark: SparkSession, path: str | None = None, fmt: str = "csv", delimiter: str = ",", multi_line: bool = False
) -> DataFrame:
    """Read the raw session table. CSV: header row, ``delimiter``, every column text.

    Fields may be quoted, with doubled quotes inside. A row with too few or too
    many fields fails the job that reads it. ``multi_line`` allows line ends inside
    quoted fields; it is off by default, because each file is then read by one task.
    """
    path = source_path(path)
    try:
        if fmt == "csv":
            reader = spark.read.option("header", True).option("inferSchema", False).option("sep", delimiter)
            reader = reader.option("quote", '"').option("escape", '"').option("multiLine", multi_line)
            # Pruned columns are not parsed, which would let ragged rows pass.
            return reader.option("mode", "FAILFAST").option("columnPruning", False).csv(path)
        return spark.read.format(fmt).load(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"Source dataset not found: {path}") from exc
        raise


def normalise_headers(df: DataFrame) -> DataFrame:
    """Strip and lower-case every column name."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


#: A time zone or offset after a time of day.
_OFFSET = r"(\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)\s*(?:Z|UTC|GMT|[+-]\d{2}(?::?\d{2})?)$"


def parse_timestamp(c: Column, formats: Sequence[str] | None = None) -> Column:
    """Coercing parse to a zone-free timestamp; unparseable gives NULL.

    The result is the written wall-clock time: an offset in the text is dropped,
    not converted, so the day does not depend on the session's time zone.
    ``formats`` (patterns of Spark's datetime syntax, tried in order) replace the
    default of ISO dates and times.
    """
    c = F.trim(c)
    c = F.when(F.length(c) > 10, F.regexp_replace(c, _OFFSET, "$1")).otherwise(c)  # a day alone has no offset
    if formats:
        return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats])
    return c.try_cast("timestamp_ntz")


def parse_id(c: Column, id_type: str = "bigint") -> Column:
    """An id of the wanted type. ``bigint`` takes integers, also written as ``1.0``; other text is NULL."""
    if id_type == "string":
        return c
    if id_type != "bigint":
        raise ValueError(f"id_type must be 'bigint' or 'string', got {id_type!r}")
    c = F.trim(c)
    return F.coalesce(c.try_cast("long"), F.regexp_replace(c, r"^([+-]?\d+)\.0*$", "$1").try_cast("long"))


def parse_number(c: Column) -> Column:
    """A double; NULL for text that is no plain number (Java's ``5d`` and ``7f`` are none)."""
    return F.when(~F.rlike(c, F.lit("[dDfF]\\s*$")) | F.rlike(F.lower(c), F.lit("inf\\s*$")), c).try_cast("double")


#: Patterns tried where dates are not ISO, each with an optional time of day.
DATE_FORMATS = tuple(
    f"{day}[ H:mm[:ss]]" for day in ("d/M/yyyy", "M/d/yyyy", "d-M-yyyy", "M-d-yyyy", "d.M.yyyy", "yyyy/M/d", "yyyy.M.d", "yyyyMMdd", "d MMM yyyy", "MMM d, yyyy")
)


def _texts(df: DataFrame, null_tokens: Sequence[str]) -> dict[str, Column]:
    """Every column as text, missing ones NULL."""
    # One literal per token, shared by every column; with more than ten values
    # the optimizer turns the IN list into a hashed set lookup.
    tokens = [F.lit(t) for t in null_tokens]
    missing = F.lit(None).cast("string")
    text = {c: F.col(c).cast("string") for c in df.columns}
    return {n: F.when(c.isin(*tokens), missing).otherwise(c) for n, c in text.items()} if tokens else text


def detect_formats(raw: DataFrame, candidates: Sequence[str] = DATE_FORMATS, null_tokens: Sequence[str] = NULL_TOKENS) -> list[str]:
    """The patterns to read the dates of ``raw`` with: none if ISO reads as many as any candidate, else the one that reads most.

    One aggregate over the date column counts what each reads of the dates that are not
    ISO. Candidates that read equally many but some date differently raise ``ValueError``
    with the counts.
    """
    df = normalise_headers(raw)
    text = _texts(df, null_tokens)["date"]
    iso = parse_timestamp(text)
    others = [F.when(iso.isNull(), parse_timestamp(text, [f])).alias(f"f{i}") for i, f in enumerate(candidates)]
    own = df.select(iso.alias("iso"), *others)
    counted = own.agg(F.count("iso").alias("iso"), *[F.count(f"f{i}").alias(f"f{i}") for i in range(len(candidates))]).first()
    best = max(counted[f"f{i}"] for i in range(len(candidates)))
    if best <= counted.iso:
        return []
    tied = [i for i in range(len(candidates)) if counted[f"f{i}"] == best]
    if len(tied) > 1:
        read = [F.col(f"f{i}") for i in tied]
        differ = own.agg(F.count_if(F.least(*read) != F.greatest(*read))).first()[0]
        if differ:
            counts = ", ".join(f"{candidates[i]}: {best}" for i in tied)
            raise ValueError(f"the date format is ambiguous ({counts}; {differ} dates differ); name one")
    return [candidates[tied[0]]]


def session_values(
    raw: DataFrame, formats: Sequence[str] | None = None, null_tokens: Sequence[str] = NULL_TOKENS, id_type: str = "bigint", numbers: bool = True
) -> dict[str, tuple[Column, Column]]:
    """Text and converted value of each column of ``raw`` that has a type other than text; NULL where it does not convert."""
    text = _texts(normalise_headers(raw), null_tokens)
    convert = {"user_id": lambda c: parse_id(c, id_type), "session_id": lambda c: parse_id(c, id_type), "date": lambda c: parse_timestamp(c, formats)}
    if numbers:
        convert |= {"order_value": parse_number, "revenue": parse_number}
    return {n: (text[n], f(text[n])) for n, f in convert.items() if n in text}


def rejected_values(raw: DataFrame, values: dict[str, tuple[Column, Column]], required: Sequence[str] = ()) -> DataFrame:
    """``column, value, reason, row`` (the raw row as JSON) and ``first`` (of its row) of every value that does not convert,
    or is missing in a ``required`` column."""
    df = normalise_headers(raw)
    faults = []
    for name, (text, value) in values.items():
        fault = F.when(text.isNotNull() & value.isNull(), F.lit("does not convert"))
        if name in required:
            fault = fault.when(text.isNull(), F.lit("missing"))
        faults.append(F.struct(F.lit(name).alias("column"), text.alias("value"), fault.alias("reason")))
    faulty = F.filter(F.array(*faults), lambda f: f.reason.isNotNull())
    own = df.select(faulty.alias("f"), F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns])).alias("row"))
    return own.select(F.posexplode("f").alias("at", "f"), "row").select("f.column", "f.value", "f.reason", "row", (F.col("at") == 0).alias("first"))


def clean_sessions(
    raw: DataFrame,
    formats: Sequence[str] | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    id_type: str = "bigint",
    bad_ids: str = "fail",
    observation: Observation | None = None,
) -> DataFrame:
    """Cleaned session table: the raw columns with coerced types, six
    case-insensitive ``<column>_flag`` ints, ``is_purchaser_session``; rows
    whose date does not parse are dropped.

    ``id_type`` is ``bigint`` or ``string``. A bigint id that does not parse fails the
    job; ``bad_ids='null'`` lets it be NULL. ``observation`` collects, while the table
    is read, ``rows``, ``undated_rows`` (the dropped ones) and ``bad_ids``.
    """
    if bad_ids not in ("fail", "null"):
        raise ValueError(f"bad_ids must be 'fail' or 'null', got {bad_ids!r}")
    df = normalise_headers(raw)
    typed = _texts(df, null_tokens)
    values = session_values(raw, formats, null_tokens, id_type)
    bad = F.lit(False)
    for name in [c for c in ("user_id", "session_id") if c in values]:
        text, parsed = values[name]
        unparsed = text.isNotNull() & parsed.isNull()
        bad = bad | unparsed
        if bad_ids == "fail" and id_type == "bigint":
            parsed = F.coalesce(parsed, _failed(name, text, "long"))
        typed[name] = parsed
    date = values["date"][1]
    typed["date"] = date
    typed["month"] = F.date_format(date.cast("date"), "yyyy-MM")
    for money_col in ("order_value", "revenue"):
        typed[money_col] = F.coalesce(values[money_col][1], F.lit(0.0))

    counted = [bad.alias("_bad_ids")] if observation is not None else []
    out = df.select(*[typed[n].alias(n) for n in df.columns], *counted)
    if observation is not None:
        out = out.observe(
            observation,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("date").isNull()).alias("undated_rows"),
            F.count_if("_bad_ids").alias("bad_ids"),
        ).drop("_bad_ids")
    flags = {f"{c}_flag": flag_ci(F.col(c)) for c in FLAG_SOURCES}
    out = out.withColumns(flags)
    out = out.withColumn("is_purchaser_session", F.col("purchase_completed_flag") == 1)
    return out.where(F.col("date").isNotNull())


def _failed(name: str, text: Column, kind: str) -> Column:
    """NULL for a missing text; fails the job for any other."""
    what = {"date": "a date", "order_value": "a number", "revenue": "a number"}.get(name, "an integer")
    return F.when(text.isNotNull(), F.raise_error(F.concat(F.lit(f"{name} is not {what}: "), text)).cast(kind))


def typed_sessions(raw: DataFrame, formats: Sequence[str] | None = None, id_type: str = "bigint", on_error: str = "fail") -> DataFrame:
    """Raw text table converted to the typed DDL schema, for bulk loads (ids are text if ``id_type`` says so).

    Empty fields are NULL. A value that does not convert fails the job, or with
    ``on_error='reject'`` leaves its row out (``rejected_values`` lists those).
    """
    from ..schema import TYPED_SCHEMA

    df = normalise_headers(raw)
    text = _texts(df, ("",))
    values = session_values(raw, formats, ("",), id_type)
    columns, whole = [], F.lit(True)
    for f in TYPED_SCHEMA.fields:
        source, value = values.get(f.name, (text[f.name], text[f.name]))
        kind = "string" if f.name in ("user_id", "session_id") and id_type == "string" else f.dataType.simpleString()
        if f.name in values and on_error == "fail":
            value = F.coalesce(value.cast(kind), _failed(f.name, source, kind))
        elif f.name in values:
            whole = whole & (source.isNull() | value.isNotNull())
        columns.append(value.cast(kind).alias(f.name))
    return (df.where(whole) if on_error == "reject" else df).select(*columns)


__all__ = [
    "DATE_FORMATS",
    "RAW_SCHEMA",
    "clean_sessions",
    "detect_formats",
    "normalise_headers",
    "parse_timestamp",
    "read_sessions",
    "rejected_values",
    "session_values",
    "source_path",
    "typed_sessions",
]
