"""Explode landed API payloads into rows (SRC-04 series, SRC-05 page envelopes).

Both run per document, in the JVM: ``arrays_zip`` + ``inline`` for parallel arrays,
``explode`` for pages. Consistency checks are returned as DataFrames of offending documents.

Payloads that land as JSON text are read as text and parsed with a corrupt-record column, so a line
that cannot be read, or lacks what every page must have, is a reject with its reason and never an
all-NULL page that disappears in an ``explode``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CORRUPT = "_corrupt_record"


def _problems(variables: Sequence[str], series_col: str, time_field: str) -> F.Column:
    """Array of problem labels of one document (empty when the document is consistent)."""
    s = F.col(series_col)
    n = F.size(s[time_field])
    checks = [F.when(s[time_field].isNull() | (n <= 0), F.lit(f"empty {time_field}"))]
    for v in variables:
        checks.append(F.when(s[v].isNull(), F.lit(f"missing {v}"))
                      .when(F.size(s[v]) != n, F.lit(f"length {v}")))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def series_problems(docs: DataFrame, variables: Sequence[str], place_cols: Sequence[str],
                    series_col: str = "daily", time_field: str = "time") -> DataFrame:
    """DQ-10 for SRC-04: documents with an empty ``time``, a missing variable, or an array whose
    length differs from ``time``'s. One row per (document, problem)."""
    return (docs.select(*place_cols, _problems(variables, series_col, time_field).alias("p"))
            .select(*place_cols, F.explode("p").alias("problem")))


def split_series(docs: DataFrame, variables: Sequence[str], series_col: str = "daily",
                 time_field: str = "time") -> dict[str, DataFrame]:
    """SRC-04: ``{"valid": consistent documents, "rejected": the others with their ``problems``}``."""
    tagged = docs.withColumn("problems", _problems(variables, series_col, time_field))
    return {"valid": tagged.where(F.size("problems") == 0).drop("problems"),
            "rejected": tagged.where(F.size("problems") > 0)}


def explode_series(docs: DataFrame, variables: Sequence[str], place_cols: Sequence[str],
                   series_col: str = "daily", time_field: str = "time",
                   required: str | None = "temperature_2m_mean", strict: bool = True) -> DataFrame:
    """SRC-04: one row per day from a document of parallel arrays, with the place columns.

    With ``strict`` a document with problems fails the job, naming them (``series_problems`` lists
    all of them, ``split_series`` sets them aside first); nothing is dropped silently. The lenient
    variant turns a missing array into NULLs and cuts or fills arrays to the length of ``time``.
    Days whose ``required`` value is NULL are dropped.
    """
    s = F.col(series_col)
    n = F.coalesce(F.size(s[time_field]), F.lit(0))
    times = s[time_field]
    if strict:
        problems = _problems(variables, series_col, time_field)
        times = F.when(F.size(problems) == 0, times).otherwise(F.raise_error(F.concat(
            F.lit("inconsistent document "), F.to_json(F.struct(*place_cols)), F.lit(": "), F.array_join(problems, ", "))))
    arrays = [times.alias(time_field)]
    for v in variables:
        arr = s[v]
        if not strict:
            arr = F.slice(F.coalesce(arr, F.array_repeat(F.lit(None).cast("double"), n)), 1, n)
        arrays.append(arr.alias(v))
    rows = docs.select(*place_cols, F.inline(F.arrays_zip(*arrays)))
    if required:
        rows = rows.where(F.col(required).isNotNull())
    return rows


def _request_totals(pages: DataFrame, request_col: str, count_col: str, data_col: str) -> DataFrame:
    """Announced count (first page's) and received records: two numbers per request."""
    return pages.groupBy(request_col).agg(
        F.min_by(F.col(count_col), F.col("page")).alias("announced"),
        F.sum(F.coalesce(F.size(data_col), F.lit(0))).alias("received"))


def page_problems(pages: DataFrame, request_col: str = "request_id", count_col: str = "count",
                  data_col: str = "data") -> DataFrame:
    """DQ-10 for SRC-05: requests whose pages hold a different number of records than the
    first page's announced ``count`` (when a count is announced)."""
    per_req = _request_totals(pages, request_col, count_col, data_col)
    return per_req.where(F.col("announced").isNotNull() & (F.col("announced") != F.col("received")))


def explode_pages(pages: DataFrame, request_col: str = "request_id", data_col: str = "data",
                  strict: bool = True, count_col: str = "count") -> DataFrame:
    """SRC-05: one row per record of every page envelope ``{count, data[]}``.

    With ``strict`` a request that received another number of records than it announced fails the
    job (``page_problems`` lists all of them); the payloads are not shuffled for the check unless
    AQE finds the two numbers per request too large to broadcast.
    """
    src = pages
    if strict:
        bad = page_problems(pages, request_col, count_col, data_col).withColumnRenamed(request_col, "_bad_request")
        told = F.raise_error(F.concat_ws(" ", F.lit("incomplete request"), F.col("_bad_request").cast("string"),
                                         F.col("received").cast("string"), F.lit("of"), F.col("announced").cast("string")))
        src = (pages.join(bad, F.col(request_col) == F.col("_bad_request"), "left")
               .withColumn(data_col, F.when(F.col("_bad_request").isNull(), F.col(data_col)).otherwise(told)))
    return src.select(request_col, "page", F.explode(data_col).alias("record")).select(
        request_col, "page", "record.*")


# ----------------------------------------------------------------------------- payloads as JSON text
def parse_json(lines: DataFrame, schema: str, payload: str = "value", required: Sequence[str] = (),
               arrays: Sequence[str] = ()) -> DataFrame:
    """``lines`` with ``_doc`` (parsed by ``schema``) and ``_reason`` (why it is refused, or NULL).

    A payload is refused when it is blank, is not JSON of that shape (a truncated document, a value
    of another type), lacks one of the ``required`` fields, or has a NULL entry in one of ``arrays``.
    The first reason that applies is given.
    """
    names = StructType.fromDDL(schema).fieldNames()
    parsed = F.from_json(F.col(payload), f"{schema}, {CORRUPT} string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    out = lines.withColumn("_parsed", parsed)
    reason = (F.when(F.coalesce(F.trim(F.col(payload)), F.lit("")) == "", F.lit("empty payload"))
              .when(F.col("_parsed").isNull() | F.col(f"_parsed.{CORRUPT}").isNotNull(), F.lit("malformed JSON")))
    for name in required:
        reason = reason.when(F.col(f"_parsed.{name}").isNull(), F.lit(f"no {name}"))
    for name in arrays:
        reason = reason.when(F.exists(F.col(f"_parsed.{name}"), lambda x: x.isNull()), F.lit(f"NULL entry in {name}"))
    doc = F.struct(*[F.col(f"_parsed.{n}").alias(n) for n in names])
    return out.withColumns({"_reason": reason, "_doc": doc}).drop("_parsed")


def json_rejects(parsed: DataFrame) -> DataFrame:
    """The refused lines of ``parse_json`` as they landed, with ``reason``."""
    return parsed.where(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason").drop("_doc")


def json_documents(parsed: DataFrame) -> DataFrame:
    """The documents of the lines that were not refused."""
    return parsed.where(F.col("_reason").isNull()).select("_doc.*")


def parse_json_pages(lines: DataFrame, schema: str, payload: str = "value", request_col: str = "request_id",
                     page_col: str = "page", data_col: str = "data") -> DataFrame:
    """``parse_json`` for page envelopes: a page names its request and number and has its records."""
    return parse_json(lines, schema, payload, (request_col, page_col, data_col), (data_col,))


def explode_json_pages(lines: DataFrame, schema: str, payload: str = "value", strict: bool = True) -> DataFrame:
    """SRC-05 on JSON text: one row per record of every page.

    With ``strict`` the first line that is refused fails the job, as does a request that received
    another number of records than it announced; otherwise ``json_rejects`` has the refused lines.
    """
    parsed = parse_json_pages(lines, schema, payload)
    if strict:
        told = F.raise_error(F.concat(F.lit("unreadable page ("), F.col("_reason"), F.lit("): "), F.substring(payload, 1, 200)))
        pages = parsed.withColumn("_doc", F.when(F.col("_reason").isNull(), F.col("_doc")).otherwise(told)).select("_doc.*")
        return explode_pages(pages)
    return explode_pages(json_documents(parsed), strict=False)


def complete_requests(pages: DataFrame, all_readable: bool = True, request_col: str = "request_id", count_col: str = "count",
                      data_col: str = "data") -> dict[str, DataFrame]:
    """``{"complete": pages of requests that add up, "incomplete": the others}``.

    A request without an announced count is complete only when every landed line could be read
    (``all_readable``): otherwise the line that announced it, or some of its pages, may be lost.
    """
    totals = _request_totals(pages, request_col, count_col, data_col)
    adds_up = F.col("announced") == F.col("received")
    good = F.coalesce(adds_up, F.lit(all_readable))
    named = totals.select(F.col(request_col).alias("_request"), good.alias("_good"))
    joined = pages.join(named, F.col(request_col) == F.col("_request")).drop("_request")
    return {"complete": joined.where("_good").drop("_good"), "incomplete": joined.where("NOT _good").drop("_good")}
