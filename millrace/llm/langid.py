"""Operator 4: language of documents by fusing text, declared language, address suffix and host priors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.scratch import stage

OUTPUTS = ("language", "confidence", "kept")
#: Hashed byte trigrams per language.
CELLS = 1 << 15
UNDETERMINED = "und"
#: Trigrams that count as independent when a text is judged alone.
SURE_TRIGRAMS = 200


def byte_classes() -> np.ndarray:
    """A-Z to a-z; ASCII bytes other than letters to a space; the rest as it is."""
    table = np.arange(256, dtype=np.uint32)
    table[65:91] += 32
    other = [b for b in range(128) if not (97 <= b <= 122 or 65 <= b <= 90)]
    table[other] = 32
    return table


def trigram_cells(text: bytes, classes: np.ndarray) -> np.ndarray:
    """Hash cell of every byte trigram that holds a letter; a blank stands before and behind the text."""
    codes = classes[np.frombuffer(b" " + text + b" ", np.uint8)]
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    worded = (b != 32) | ((a != 32) & (c != 32))
    mixed = (a[worded] << np.uint32(16) | b[worded] << np.uint32(8) | c[worded]) * np.uint32(0x9E3779B1)
    return (mixed >> np.uint32(17)).astype(np.int64)


class TextModel:
    """Log-likelihood of a trigram cell in every language."""

    def __init__(self, languages: list[str], counts: np.ndarray, smoothing: float = 0.1):
        self.languages = languages
        sums = counts.sum(axis=1, keepdims=True) + smoothing * CELLS
        self.table = np.log((counts + smoothing) / sums).T.copy()

    def scores(self, text: bytes, classes: np.ndarray, piece: int = 1 << 18) -> tuple[int, np.ndarray]:
        """(trigrams, mean log-likelihood by language) of the whole text."""
        count, sums = 0, np.zeros(len(self.languages))
        for first in range(0, max(1, len(text)), piece):
            cells = trigram_cells(text[first: first + piece], classes)
            found = np.bincount(cells, minlength=CELLS)
            used = np.flatnonzero(found)
            sums += found[used] @ self.table[used]
            count += len(cells)
        return count, sums / max(count, 1)


def fit_text_model(docs: DataFrame, text: Column, label: Column, identity: Column, rows_per_language: int = 500) -> TextModel:
    """Trigram counts of a bounded sample of labelled rows: the ``rows_per_language`` with the smallest id hash of each label.

    Every label is a language, however few its rows.  The model holds 256 KB of
    each.
    """
    labelled = docs.select(label.cast("string").alias("label"), identity.alias("id"), text.alias("text"))
    labelled = labelled.where("label IS NOT NULL AND id IS NOT NULL AND text <> ''")
    hashed = labelled.select("label", "id", F.md5(F.concat(F.lit("fit:"), F.col("id").cast("string"))).alias("hash"))
    counts = stage(hashed.groupBy(F.col("label").alias("_label")).agg(F.count(F.lit(1)).alias("n")), "language-labels")
    # about four times the rows wanted, whatever the table's size, are ranked
    share = F.conv(F.substring("hash", 1, 8), 16, 10).cast("double") / (1 << 32)
    few = hashed.join(counts, F.col("label") == F.col("_label")).where(share * F.col("n") < 4 * rows_per_language)
    order = Window.partitionBy("label").orderBy("hash", "id")
    chosen = few.select("label", "id", "hash").distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= rows_per_language)
    chosen = stage(chosen.select(F.col("label").alias("_label"), F.col("id").alias("_id")), "language-sample")
    sample = labelled.join(chosen, (F.col("label") == F.col("_label")) & (F.col("id") == F.col("_id")))
    sample = sample.groupBy("label", "id").agg(F.min("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, sums = byte_classes(), {}
        for batch in batches:
            for label, body in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                rows, cells = sums.get(label, (0, 0))
                sums[label] = rows + 1, cells + np.bincount(trigram_cells(body.as_py(), classes), minlength=CELLS)
        for label, (rows, cells) in sums.items():
            used = np.flatnonzero(cells)
            columns = [pa.array([label] * (len(used) + 1)), pa.array(np.r_[-1, used]), pa.array(np.r_[rows, cells[used]])]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "cell", "n"])

    schema = T.StructType([T.StructField("label", T.StringType()), T.StructField("cell", T.LongType()), T.StructField("n", T.LongType())])
    sums = stage(sample.select("label", "text").mapInArrow(count, schema).groupBy("label", "cell").agg(F.sum("n").alias("n")), "language-cells")
    found = sums.toArrow()
    languages = sorted(set(found["label"].to_pylist()))
    counts = np.zeros((len(languages), CELLS))
    for k, language in enumerate(languages):
        own = found.filter(pc.equal(found["label"], language))
        cells = own["cell"].to_numpy()
        counts[k, cells[cells >= 0]] = own["n"].to_numpy()[cells >= 0]
    return TextModel(languages, counts)


def text_evidence(rows: DataFrame, model: TextModel) -> DataFrame:
    """``rows`` with trigrams, scores (one mean log-likelihood per language) and sure in place of the last column, the text.

    ``sure`` is the number of a language to which the text alone gives a posterior of 0.9.
    """
    added = [T.StructField("trigrams", T.LongType()), T.StructField("scores", T.ArrayType(T.DoubleType())), T.StructField("sure", T.IntegerType())]
    schema = T.StructType(rows.schema.fields[:-1] + added)

    def sure(count: int, scores: np.ndarray) -> int | None:
        if not count or not len(scores) or scores.max() < -math.log(CELLS):
            return None
        shares = np.exp((scores - scores.max()) * min(count, SURE_TRIGRAMS))
        return int(scores.argmax()) if shares.sum() <= 1 / 0.9 else None

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = byte_classes()
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary())
            found = [model.scores(t.as_py() or b"", classes) for t in texts]
            columns = [
                pa.array([n for n, _ in found], pa.int64()), pa.array([s.tolist() for _, s in found], pa.list_(pa.float64())),
                pa.array([sure(*f) for f in found], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=schema.names)

    return rows.mapInArrow(score, schema)


def label_counts(facts: DataFrame, key: str, languages: int) -> DataFrame:
    """(key, by_language): sure texts of each language per value of ``key``, without null."""
    sums = [F.sum((F.col("sure") == k).cast("bigint")) for k in range(languages)]
    return facts.where(F.col("sure").isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_{key}")).agg(F.array(*sums).alias(f"{key}_counts"))


def fuse(
    facts: DataFrame, model: TextModel, carried: list[str], *, text_weight: int = 200, host_strength: float = 10.0,
    domain_strength: float = 50.0, least_confidence: float = 0.5,
) -> DataFrame:
    """The ``carried`` columns of ``facts`` with language, confidence (its posterior) and kept.

    ``facts`` holds trigrams, scores and sure of :func:`text_evidence` and the
    texts declared, suffix, host and domain.  Evidence: the mean trigram
    log-likelihood times the trigrams, at most ``text_weight``, as neighbouring
    trigrams aren't independent; how often sure texts of a language go with the
    declared language and with the address suffix, smoothed; and the prior of the
    host, drawn towards its domain's and that towards the corpus's by
    ``host_strength`` and ``domain_strength`` counted texts.  All those counts are
    grouped aggregates over every row.

    A text that every language explains worse than even use of all trigrams, and
    one without letters (null, empty), is ``und``.  Not kept are ``und`` and
    confidences below ``least_confidence``.  Null evidence says nothing.  Repeated
    rows are counted each.  Of languages with the same posterior the first by name
    wins.  Without languages nothing can be told: every row is ``und``, and those
    with letters stay.
    """
    size, names = len(model.languages), [*model.languages, UNDETERMINED]
    if not size:
        return facts.select(*carried, F.lit(UNDETERMINED).alias("language"), F.lit(1.0).alias("confidence"), (F.col("trigrams") > 0).alias("kept"))
    totals = facts.where("sure IS NOT NULL").agg(F.array(*[F.sum((F.col("sure") == k).cast("bigint")) for k in range(size)]), F.count_distinct("declared"), F.count_distinct("suffix")).first()
    sums, kinds = [n or 0 for n in totals[0]], {"declared": totals[1], "suffix": totals[2]}
    shares = [(n + 1) / (sum(sums) + size) for n in sums]

    for key in ("declared", "suffix", "host", "domain"):
        counts = stage(label_counts(facts, key, size), f"language-{key}")
        facts = facts.join(counts, F.col(key) == F.col(f"_{key}"), "left").drop(f"_{key}")

    def share_of(key: str, strength: float, above: list[Column]) -> list[Column]:
        """Shares of a host or domain, drawn towards those ``above``."""
        found = [F.coalesce(F.col(f"{key}_counts")[k], F.lit(0)) for k in range(size)]
        total = sum(found[1:], found[0])
        return [(n + F.lit(strength) * a) / (total + F.lit(strength)) for n, a in zip(found, above)]

    prior = share_of("domain", domain_strength, [F.lit(s) for s in shares])
    facts = facts.withColumns({f"_p{k}": p for k, p in enumerate(prior)})
    facts = facts.withColumns({f"_p{k}": p for k, p in enumerate(share_of("host", host_strength, [F.col(f"_p{k}") for k in range(size)]))})
    weight = F.least("trigrams", F.lit(text_weight))
    posterior = []
    for k in range(size):
        value = F.log(f"_p{k}") + weight * F.col("scores")[k]
        for key in ("declared", "suffix"):
            seen = F.coalesce(F.col(f"{key}_counts")[k], F.lit(0))
            fits = F.log((seen + F.lit(0.5)) / F.lit(sums[k] + 0.5 * (kinds[key] + 1)))
            value = value + F.when(F.col(key).isNotNull(), fits).otherwise(F.lit(0.0))
        posterior.append(value)
    facts = facts.withColumn("_l", F.array(*posterior))
    top = F.array_max("_l")
    facts = facts.withColumn("_sum", F.aggregate(F.transform("_l", lambda v: F.exp(v - top)), F.lit(0.0), lambda a, v: a + v))
    unknown = (F.col("trigrams") == 0) | (F.array_max("scores") < F.lit(-math.log(CELLS)))
    best = F.element_at(F.array(*[F.lit(n) for n in names]), F.when(unknown, F.lit(size + 1)).otherwise(F.array_position("_l", top).cast("int")))
    confidence = F.when(unknown, F.lit(1.0)).otherwise(1 / F.col("_sum"))
    return facts.select(
        *carried, best.alias("language"), confidence.alias("confidence"),
        (~unknown & (confidence >= least_confidence)).alias("kept"),
    )


def page_evidence(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(doc, declared, suffix, host, domain): what the page of a document says, by the number in its address.

    Of several pages of one document that with the smallest page id counts.
    """
    address, body = F.col(f"`{url}`"), F.col(f"`{html}`")
    name = F.lower(F.regexp_extract(address, r"://([^/?#:]*)", 1))
    labels = F.split(name, r"\.")
    markup = F.lower(F.regexp_extract(body, r"""(?i)<html[^>]*\blang=["']?([a-z]+)""", 1))
    known = pages.select(
        F.regexp_extract(address, r"://[^/?#]*(?:/[^?#]*?)?/([0-9]+)(?:[/.?#]|$)", 1).try_cast("bigint").alias("doc"),
        F.col(f"`{page_id}`").alias("page"), F.nullif(markup, F.lit("")).alias("declared"),
        F.nullif(F.element_at(labels, -1), F.lit("")).alias("suffix"), F.nullif(name, F.lit("")).alias("host"),
        F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), ".")).alias("domain"),
    ).where("doc IS NOT NULL")
    first = F.min_by(F.struct("declared", "suffix", "host", "domain"), F.col("page"))
    return known.groupBy("doc").agg(first.alias("page")).select("doc", "page.*")


def identify_documents(
    docs: DataFrame, pages: DataFrame | None, *, model: TextModel | None = None, text: str = "text", declared: str = "lang",
    source: str = "source", identity: str = "doc_id", carried: tuple[str, ...] = (), **settings,
) -> DataFrame:
    """(identity, carried, language, confidence, kept) of ``docs``, by text, declared language, source and, where there is one, page.

    A document without a page has its source as host and no suffix; its declared
    language stands in for the markup's.  The text model is fitted on ``docs``
    unless it is given.
    """
    if model is None:
        model = fit_text_model(docs, F.col(f"`{text}`"), F.col(f"`{declared}`"), F.col(f"`{identity}`"))
    kept = list(dict.fromkeys([identity, *carried]))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("own"), F.lower(f"`{declared}`").alias("declared"),
        F.col(f"`{source}`").cast("string").alias("host"), F.col(f"`{text}`").alias("text"),
    )
    facts = stage(text_evidence(rows, model), "language-facts").withColumn("domain", F.col("host")).withColumn("suffix", F.lit(None).cast("string"))
    if pages is not None:
        page = stage(page_evidence(pages), "language-pages")
        page = page.select([F.col(c).alias(f"_{c}") for c in page.columns])
        facts = facts.join(page, F.col("own").getField(identity) == F.col("_doc"), "left")
        facts = facts.withColumns({c: F.coalesce(f"_{c}", c) for c in ("declared", "suffix", "host", "domain")})
        facts = stage(facts.drop(*page.columns), "language-evidence")
    found = fuse(facts, model, ["own"], **settings)
    own = [F.col("own").getField(c).alias(c) for c in kept if c not in OUTPUTS]
    return found.select(*own, *OUTPUTS)
