"""Language identification by Bayesian evidence fusion.

For each language, and for "und" (no language: bytes at random), these are added as logarithms:

* text: likelihood of the byte trigrams of the whole text under a smoothed model of each language with noise, fitted on a
  bounded sample of the rows of each label (together about ``SAMPLE``). A byte is in three trigrams, so a third of it counts;
* declared language: how often texts that are most likely in a language declare this one;
* address suffix: how much more often texts most likely in a language have this last label of a host;
* host prior: the share of languages among a host's other texts, smoothed by its domain's, smoothed by all rows'. A row's own vote is taken off
  its host's and domain's counts, so no text speaks for itself twice.

The three latter come from grouped aggregations over all rows, of what the text alone says. Hosts and suffixes join back to
their rows, and domains to their hosts, with heavy ones broadcast, so a host may hold any share of the rows and a domain of the hosts. A domain is the
last two labels of a host, or three where the last two are a country's and a short one of its own (``co.uk``).

Every declared language is counted over all rows and gets a model. Only beyond the ``LANGUAGES`` most frequent ones, whose models take 262 MB, the others share
one, REST; a row that REST or nothing explains is in the language that it declares, if this has no model of its own.

Defined results: a text without trigrams (null, empty, under three bytes) is judged by the other evidence, counts in no share and has a null text_lang; without any evidence the prior decides; a null host,
suffix or declared language gives no evidence; languages named in other cases or with a region (``EN-us``) count as the language, names that
aren't codes of two or three letters (``english``) as none; long texts are read whole;
repeated rows repeat their result; an empty table gives an empty table. A row is accepted when the most likely
language isn't "und" and has at least ``ACCEPT`` of the probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import cut, join_groups

#: Labelled rows that the text model is fitted on, about, dealt evenly to labels; the LANGUAGES most frequent have models, the rest share REST.
SAMPLE, LANGUAGES, REST = 8000, 1000, "other"
#: Trigram classes, smoothing of their counts, and the part of a text's log-likelihood that counts.
CLASSES, ALPHA, TEMPER = 1 << 16, 0.1, 1 / 3
#: Share of a language's trigrams that may be anything, as names, numbers and keys are: a text is "und" only if nearly all of it is.
NOISE = 0.5
#: Weight of a wider level's shares in a narrower one, in rows; of declared languages and suffixes in rows; prior of "und".
HOST_WEIGHT, EVIDENCE_WEIGHT, UND = 10.0, 5.0, 0.001
ACCEPT = 0.5
#: What isn't text in a page: scripts, styles and comments, to the end of the page where they aren't closed, tags and entities. Each part is read once.
MARKUP = r"(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>|&[a-z0-9#]{1,8};"
#: Characters of a text whose trigrams are looked up at once.
AT_ONCE = 1 << 20


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Classes of all byte trigrams of the text in lower case, in blocks."""
    low = text.lower().encode("utf-8", "surrogatepass")
    x = np.frombuffer(low, np.uint8).astype(np.uint32)
    for k in range(0, max(len(x) - 2, 0), AT_ONCE):
        y = x[k : k + AT_ONCE + 2]
        with np.errstate(over="ignore"):
            yield (((y[:-2] << 16) | (y[1:-1] << 8) | y[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(16)


@dataclass
class TextModel:
    """Log-probability of each trigram class in each language, REST among them if there is one; the last is "und", the same for all classes."""

    languages: list[str]
    table: np.ndarray

    def of(self, text: str) -> np.ndarray:
        total = np.zeros(len(self.languages) + 1)
        for block in trigrams(text):
            total += self.table[block].sum(0, dtype=np.float64)
        return total * TEMPER


def language(column) -> Column:
    """Two- or three-letter code in lower case, or null."""
    code = F.lower(F.regexp_extract(F.trim(column), r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    return F.when(code != "", code)


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", sample: int = SAMPLE, most: int = LANGUAGES) -> TextModel:
    """Text model from a part of each label's rows, about ``sample`` together: all of rare labels. Labels are counted over all rows.

    Labels beyond the ``most`` frequent are fitted together. What reaches the driver is bounded by languages x classes.
    """
    rows = labelled.select(F.col(text).alias("text"), language(F.col(label)).alias("label")).where("label IS NOT NULL AND text IS NOT NULL")
    sizes = sorted(((n, x) for x, n in rows.groupBy("label").count().collect()), key=lambda r: (-r[0], r[1]))
    languages = sorted(x for _, x in sizes[:most])
    rest = sum(n for n, _ in sizes[most:])
    names = [*languages, REST] if rest else languages
    each = sample / max(1, len(names))
    place = {x: i for i, x in enumerate(languages)}

    def by_label(values: dict, default) -> Column:
        known = [F.lit(v) for pair in values.items() for v in pair]
        return F.coalesce(F.element_at(F.create_map(*known), F.col("label")), F.lit(default)) if known else F.lit(default)

    part = by_label({x: min(1.0, each / n) for n, x in sizes[:most]}, min(1.0, each / max(1, rest)))
    chosen = rows.where(F.rand(42) < part).select("text", by_label(place, len(languages)).alias("place"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for text, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = found.setdefault(at, np.zeros(CLASSES, np.int64))
                for block in trigrams(text):
                    own += np.bincount(block, minlength=CLASSES)
        for at, own in found.items():
            classes = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(classes), at, np.int32)), pa.array(classes.astype(np.int32)), pa.array(own[classes])], names=["place", "class", "n"])

    sums = chosen.mapInArrow(count, "place int, class int, n long").groupBy("place", "class").agg(F.sum("n").alias("n")).toArrow()
    table = np.full((CLASSES, len(names) + 1), ALPHA)
    table[sums["class"].to_numpy(), sums["place"].to_numpy()] += sums["n"].to_numpy()
    return TextModel(names, np.log((1 - NOISE) * table / table.sum(0) + NOISE / CLASSES).astype(np.float32))


def page_evidence(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Web pages as evidence rows: id, text without markup, declared language, host, domain and suffix."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    text = F.regexp_replace(F.coalesce(html, F.lit("")), MARKUP, " ")
    declared = F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<html[^<>]*\blang\s*=\s*[\"']?([A-Za-z_-]+)", 1)
    named = F.when(host != "", host)
    last, before = F.substring_index(named, ".", -1), F.substring_index(F.substring_index(named, ".", -2), ".", 1)
    shared = (F.length(last) == 2) & (F.length(before) <= 3) & (F.size(F.split(named, r"\.")) > 2)
    return pages.select(
        F.col(key).alias("id"), text.alias("text"), language(declared).alias("declared"), named.alias("host"),
        F.when(shared, F.substring_index(named, ".", -3)).otherwise(F.substring_index(named, ".", -2)).alias("domain"), last.alias("suffix"),
    )


def document_evidence(docs: DataFrame, key: str = "doc_id", text: str = "text", declared: str = "lang", source: str = "source") -> DataFrame:
    """Documents as evidence rows: the source stands for the host, there is no domain or suffix."""
    none = F.lit(None).cast("string")
    return docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), language(F.col(declared)).alias("declared"), F.col(source).cast("string").alias("host"), none.alias("domain"), none.alias("suffix"))


def _shares(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Rows of each group by the language that the text alone makes most likely; ``size`` counts also those whose text says nothing."""
    return rows.groupBy(*keys).agg(F.count("*").alias("size"), F.count("best").alias("rows"), *(F.count_if(F.col("best") == i).alias(f"n{i}") for i in range(n)))


def fuse(evidence: DataFrame, model: TextModel) -> DataFrame:
    """Evidence rows to id, lang, confidence, accepted, and the language that the text alone makes most likely."""
    spark = evidence.sparkSession
    sent, names = spark.sparkContext.broadcast(model), [*model.languages, "und"]
    k = len(names)

    def likelihood(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = sent.value
        for texts in batches:
            yield pa.array([own.of(t or "").tolist() for t in texts.to_pylist()], pa.list_(pa.float64()))

    text_log = evidence.select("id", "declared", "host", "domain", "suffix", F.arrow_udf(likelihood, "array<double>")("text").alias("text_log"))
    best = F.when(F.array_min("text_log") < 0, F.array_position("text_log", F.array_max("text_log")).cast("int") - 1)
    known = F.when(F.col("declared").isin(model.languages), F.col("declared")).when(F.col("declared").isNotNull(), F.lit(REST))
    rows = cut(text_log.withColumn("best", best).withColumn("said", known))

    everything = _shares(rows, [], k).first()
    total = everything["rows"]
    prior = [(1 - UND) * (((everything[f"n{i}"] or 0) + 1) / (total + k)) for i in range(k - 1)] + [UND]
    said = {r["said"]: r for r in _shares(rows.where("said IS NOT NULL AND best IS NOT NULL"), ["said"], k).collect()}
    declared_rows = max(1, sum(r["rows"] for r in said.values()))
    per_language = [sum(r[f"n{i}"] for r in said.values()) for i in range(k)]

    def says(name: str, i: int) -> float:
        """P(declared | language), smoothed by how often it is declared at all."""
        r = said[name]
        return (r[f"n{i}"] + EVIDENCE_WEIGHT * r["rows"] / declared_rows) / (per_language[i] + EVIDENCE_WEIGHT)

    def logs(values) -> Column:
        return F.array(*(F.lit(float(np.log(v))) for v in values))

    spoken = [(name, np.log([says(name, i) for i in range(k)]).tolist()) for name in sorted(said)]  # one row for each language
    declared_log = F.broadcast(spark.createDataFrame(spoken, "said string, declared_log array<double>"))

    none = logs([1.0] * k)
    hosts = _shares(rows.where("host IS NOT NULL"), ["host", "domain"], k)
    hosts = cut(hosts.select("host", "domain", "size", "rows", F.array(*(f"n{i}" for i in range(k))).alias("n")))
    wide = [F.sum(F.get("n", F.lit(i))) for i in range(k)]
    domains = hosts.where("domain IS NOT NULL").groupBy("domain").agg(F.count("*").alias("hosts"), F.sum("rows").alias("domain_rows"), F.array(*wide).alias("d"))
    stats = _with(hosts, cut(domains.select("domain", "hosts", F.struct("domain_rows", "d").alias("wide"))), "domain", "hosts", F.lit(None), "wide")
    counts = cut(stats.select("host", "size", F.struct("rows", "n", "wide.domain_rows", "wide.d").alias("counts")))
    placed = _with(rows, counts, "host", "size", F.lit(None), "counts")
    c = F.col("counts")
    votes = F.when(F.col("best").isNull(), 0).otherwise(1)
    domain_rows = F.when(c["domain_rows"].isNull(), 0).otherwise(c["domain_rows"] - votes)

    def host_log(i: Column) -> Column:
        own = F.when(F.col("best") == i, 1).otherwise(0)
        of_domain = F.when(c["d"].isNull(), 0).otherwise(F.get(c["d"], i) - own)
        smooth = (of_domain + HOST_WEIGHT * F.get(F.array(*map(F.lit, prior)), i)) / (domain_rows + HOST_WEIGHT)
        return F.log((F.get(c["n"], i) - own + HOST_WEIGHT * smooth) / (c["rows"] - votes + HOST_WEIGHT))

    placed = placed.withColumn("host_log", F.when(c.isNull(), logs(prior)).otherwise(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), host_log)))

    suffixes = _shares(rows.where("suffix IS NOT NULL"), ["suffix"], k)
    at_all = max(1, rows.where("suffix IS NOT NULL AND best IS NOT NULL").count())
    lift = [F.log((F.col(f"n{i}") + EVIDENCE_WEIGHT * F.col("rows") / at_all) / (F.lit(float(everything[f"n{i}"] or 0)) + EVIDENCE_WEIGHT)) - F.log(F.col("rows") / at_all) for i in range(k)]
    suffix_logs = cut(suffixes.select("suffix", "size", F.when(F.col("rows") > 0, F.array(*lift)).otherwise(none).alias("suffix_log")))
    placed = _with(placed, suffix_logs, "suffix", "size", none, "suffix_log")

    placed = placed.join(declared_log, "said", "left")
    summed = F.zip_with(F.zip_with("text_log", F.coalesce("declared_log", none), lambda a, b: a + b), F.zip_with("host_log", "suffix_log", lambda a, b: a + b), lambda a, b: a + b)
    judged = placed.withColumn("sum", summed).withColumn("top", F.array_max("sum"))
    share = F.transform("sum", lambda x: F.exp(x - F.col("top")))
    whole = F.aggregate(share, F.lit(0.0), lambda a, x: a + x)
    named = F.element_at(F.array(*map(F.lit, names)), F.array_position("sum", F.col("top")).cast("int"))
    unmodelled = F.coalesce(named.isin(REST, "und") & (F.col("said") == REST), F.lit(False))
    lang = F.when(unmodelled, F.col("declared")).otherwise(named)
    chance = F.when(unmodelled, sum(share[i] for i, x in enumerate(names) if x in (REST, "und"))).otherwise(1.0) / whole
    text_lang = F.when(F.col("best").isNotNull(), F.element_at(F.array(*map(F.lit, names)), F.col("best") + 1))
    return judged.select("id", lang.alias("lang"), chance.alias("confidence"), ((lang != "und") & (chance >= ACCEPT)).alias("accepted"), text_lang.alias("text_lang"))


def _with(rows: DataFrame, groups: DataFrame, key: str, size: str, default, column: str) -> DataFrame:
    """Rows with the column of their group, and the default where the key is null. ``size`` counts the rows of a group."""
    named = rows.where(F.col(key).isNotNull())
    found = join_groups(named, groups, key, size, named.count()).drop(size)
    return found.unionByName(rows.where(F.col(key).isNull()).withColumn(column, default.cast(groups.schema[column].dataType)))
