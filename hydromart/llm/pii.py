"""Personal data by fixed patterns and by information-theoretic disclosure; DataFrame functions only.

Base spans are the matches of four patterns that pass their check. Offsets come from the lengths of
the text between matches, summed per document and kind, so no Python sees a text.

Terms that give an entity away are found from corpus co-occurrence. An entity is a matched value.
A term is a run of letters outside the base spans. With document counts ``n_et`` (entity and term in
one document), ``n_e``, ``n_t`` and ``N``, the pointwise mutual information
``log2(n_et N / (n_e n_t))`` says how much of the entity's information content ``log2(N / n_e)`` the
term discloses. Terms seen with the entity in ``SUPPORT`` documents or more that disclose
``DISCLOSURE`` of it or more become spans of kind ``term`` wherever they stand, also in documents
without the entity, where they give it away.

All counts are aggregated map-side first; entities of fewer than ``SUPPORT`` documents are left out
before they meet the words, for no term can reach the support with them. All counts are of
distinct (``doc_id``, text).

Defined results: null text is empty; repeated rows of equal text get equal spans; a null ``doc_id``
is a document of its own text; an empty table gives no rows; columns other than ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hydromart.llm.common import Scratch

# The contract's patterns; possessive where nothing can follow, and started only where a run of
# the first class starts (or the last match ended), which finds the same matches in linear time.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without these holds no match that could pass.
_NEEDED = {
    "email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]",
}
_IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
KINDS = ("email", "ip", "card", "phone", "term")
SUPPORT = 3
DISCLOSURE = 0.8
MIN_TERM = 3


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _passes() -> Column:
    digits = F.regexp_replace("value", "[^0-9]", "")
    n = F.length(digits)
    return (F.when(F.col("kind") == "email", F.lit(True))
            .when(F.col("kind") == "ip", F.col("value").rlike(_IP_PARTS))
            .when(F.col("kind") == "card", n.between(14, 19) & F.expr("luhn_check(regexp_replace(value, '[^0-9]', ''))"))
            .otherwise(n.between(10, 15)))


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, th, kind, start, end, value): matches that pass; ``th`` is the hash of the text."""
    none = F.array().cast("array<string>")
    kinds = [F.struct(F.lit(k).alias("kind"),
                      F.when(_text().rlike(_NEEDED[k]), F.regexp_extract_all(_text(), F.lit(p), F.lit(0))).otherwise(none).alias("m"),
                      F.when(_text().rlike(_NEEDED[k]), F.split(_text(), p, -1)).otherwise(none).alias("g"))
             for k, p in PATTERNS.items()]
    found = (docs.select("doc_id", F.xxhash64("text").alias("th"), F.explode(F.array(*kinds)).alias("k"))
             .where(F.size("k.m") > 0))
    return _placed(found).where(_passes())


def _placed(found: DataFrame) -> DataFrame:
    """(doc_id, th, kind, start, end, value) from the matches ``k.m`` and the texts ``k.g`` between them."""
    # one row per match with the text before it; the last row holds the text after the last match
    parts = (found.select("doc_id", "th", "k.kind", F.posexplode(F.arrays_zip("k.g", "k.m")).alias("i", "z"))
             .select("doc_id", "th", "kind", "i", F.col("z.m").alias("value"), F.length("z.g").alias("gap")))
    # repeated rows are one; the same partitioning serves the window
    parts = (parts.repartition("doc_id", "th", "kind").groupBy("doc_id", "th", "kind", "i")
             .agg(*[F.first(c).alias(c) for c in ("value", "gap")]))
    order = W.partitionBy("doc_id", "th", "kind").orderBy("i")
    size = F.col("gap") + F.coalesce(F.length("value"), F.lit(0))
    placed = (parts.withColumn("end", F.sum(size).over(order.rowsBetween(W.unboundedPreceding, 0)).cast("int"))
              .where(F.col("value").isNotNull()))
    return placed.select("doc_id", "th", "kind", (F.col("end") - F.length("value")).alias("start"), "end", "value")


def blanked(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, th, text, private): every distinct text with its base spans turned into spaces."""
    span = F.struct("start", "end")
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), _text().alias("text"), F.lit(None).cast("struct<start:int,end:int>").alias("span"))
    rows = rows.unionByName(spans.select("doc_id", "th", F.lit(None).cast("string").alias("text"), span.alias("span")))
    whole = rows.groupBy("doc_id", "th").agg(F.first("text", ignorenulls=True).alias("text"), F.collect_list("span").alias("spans"))
    blank = F.aggregate("spans", F.col("text"), lambda t, s: F.overlay(
        t, F.repeat(F.lit(" "), s["end"] - s["start"]), s["start"] + 1, s["end"] - s["start"]))
    return whole.select("doc_id", "th", blank.alias("text"), (F.size("spans") > 0).alias("private"))


def _terms() -> Column:
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+", -1))
    return F.filter(words, lambda w: F.length(w) >= MIN_TERM)


def _same() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("th") == F.col("_th"))


def disclosing_terms(texts: DataFrame, spans: DataFrame, scratch: Scratch, support: int = SUPPORT,
                     disclosure: float = DISCLOSURE) -> DataFrame:
    """(entity, term, share): terms that disclose at least ``disclosure`` of the entity's information."""
    value = (F.when(F.col("kind") == "email", F.lower("value")).when(F.col("kind") == "ip", F.col("value"))
             .otherwise(F.regexp_replace("value", "[^0-9]", "")))
    held = scratch.write(spans.select("doc_id", "th", F.concat_ws(":", "kind", value).alias("entity")).distinct(), "held")
    entities = held.groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= support)
    inside = (held.join(entities, "entity").groupBy(F.col("doc_id").alias("_doc"), F.col("th").alias("_th"))
              .agg(F.collect_list(F.struct("entity", "n_e")).alias("entities")))
    private = texts.where("private")
    seen = (private.join(inside, _same()).select(_terms().alias("terms"), F.explode("entities").alias("e"))
            .select("e.entity", "e.n_e", F.explode("terms").alias("term")))
    together = seen.groupBy("entity", "n_e", "term").agg(F.count("*").alias("n_et")).where(F.col("n_et") >= support)
    together = scratch.write(together, "together")
    # counted before the join: a semi-join would be pushed below the count and pass every single word
    everywhere = texts.select(F.explode(_terms()).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    total = texts.agg(F.count("*").alias("n"))
    joined = together.join(everywhere, "term").withColumn("n", total.scalar())
    information = F.log2(F.col("n") / F.col("n_e"))
    mutual = F.log2(F.col("n_et") * F.col("n") / (F.col("n_e") * F.col("n_t")))
    return (joined.where(information > 0).select("entity", "term", (mutual / information).alias("share"))
            .where(F.col("share") >= disclosure - 1e-9))


def term_spans(texts: DataFrame, telling: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, th, kind, start, end): the terms of ``telling`` wherever they stand outside base spans."""
    chosen = scratch.write(telling.select("term").distinct(), "chosen")
    hits = (texts.select("doc_id", "th", F.explode(_terms()).alias("term")).join(chosen, "term", "left_semi")
            .groupBy(F.col("doc_id").alias("_doc"), F.col("th").alias("_th")).agg(F.sort_array(F.collect_list("term")).alias("terms")))
    pattern = F.concat(F.lit(r"(?<!\p{L})(?iu:"), F.array_join("terms", "|"), F.lit(r")(?!\p{L})"))
    own = texts.join(hits, _same()).select("doc_id", "th", "text", pattern.alias("pattern"))
    found = own.select("doc_id", "th", F.struct(
        F.lit("term").alias("kind"), F.regexp_extract_all("text", F.col("pattern"), F.lit(0)).alias("m"),
        F.split("text", F.col("pattern"), F.lit(-1)).alias("g")).alias("k"))
    return _placed(found).drop("value")


def find_pii(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """(doc_id, th, kind, start, end): base spans and term spans of every text."""
    scratch = Scratch(docs.sparkSession, "pii")
    spans = scratch.write(base_spans(docs), "spans")
    texts = scratch.write(blanked(docs, spans), "texts")
    telling = scratch.write(disclosing_terms(texts, spans, scratch, support, disclosure), "telling")
    terms = term_spans(texts, telling, scratch)
    return spans.select("doc_id", "th", "kind", "start", "end").unionByName(terms)


def _sorted_spans(found: DataFrame) -> DataFrame:
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    return (found.groupBy(F.col("doc_id").alias("_doc"), F.col("th").alias("_th"))
            .agg(F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("spans")))


def sanitise(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs``, all columns, with personal data generalised to its kind and terms removed.

    Of overlapping spans the one that starts first (then the kind listed first) is replaced.
    """
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    before = W.partitionBy("doc_id", "th").orderBy("start", rank, "end").rowsBetween(W.unboundedPreceding, -1)
    clear = (found.withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(0)))
             .where(F.col("start") >= F.col("reach")))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64("text").alias("_row_th"))
    both = packed.join(_sorted_spans(clear), F.col("_doc").eqNullSafe(F.col("row.doc_id")) & (F.col("_row_th") == F.col("_th")), "left")
    text = F.col("row.text")
    pieces = F.transform("spans", lambda s, i: F.concat(
        F.substr(text, F.when(i == 0, F.lit(1)).otherwise(F.get(F.col("spans"), i - 1)["end"] + 1),
                 s["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("spans"), i - 1)["end"])),
        F.when(s["kind"] == "term", F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))))
    rest = F.substr(text, F.element_at("spans", -1)["end"] + 1, F.length(text))
    new = F.when(F.col("spans").isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), rest))
    return both.select(*[(new if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _joined(kinds: tuple[str, ...]) -> Column:
    chosen = F.filter(F.coalesce("spans", F.array()), lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"))
    spans = _sorted_spans(find_pii(docs))
    both = rows.join(spans, rows.doc_id.eqNullSafe(F.col("_doc")) & (rows.th == F.col("_th")), "left")
    kinds = F.transform(F.coalesce("spans", F.array()), lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _is(k))).cast("long").alias(f"n_{k}") for k in PATTERNS]
    base = tuple(PATTERNS)
    return both.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(KINDS).alias("spans"))


def _is(kind: str):
    return lambda k: k == kind
