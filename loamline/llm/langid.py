"""Language identification by Bayesian evidence fusion.

Three kinds of evidence about a document are multiplied: the likelihood of its text under byte-trigram models, the likelihood of the language
that its markup or metadata declares (how often texts of each language declare which, by grouped counts), and a prior of its host. Host priors are smoothed
by the host's address suffix (or the family of names it belongs to), and those by all documents: counts of what the texts say, by grouped aggregation
over the whole table. The label that the models are fitted on is no evidence: a declaration is the markup's, or another column's.

The models run over the texts once; their likelihoods are written with the hosts and declarations, and all counts and posteriors come from that table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import unused
from .shared import bounded, discard, materialise

#: Slots of the trigram tables, and bytes scored at a time.
SLOTS, PIECE = 1 << 16, 1 << 20
#: The models are fitted on at most so many labelled documents a language, and so many characters from the middle of each: a bounded sample by md5 of doc_id.
SAMPLE_DOCS, SAMPLE_CHARS = 300, 20_000
#: Labels that name more languages than this are refused: a model is half a megabyte on the driver, and a column with thousands of values holds something else.
MOST_LANGUAGES = 400
#: The model of a language with fewer labelled documents is mixed with this share of what all languages' documents hold.
LEAST_DOCS, SHARED = 10, 0.2
#: Trigrams overlap and depend on each other; their log-likelihood counts for this share.
TEXT_WEIGHT = 0.3
#: Documents that a suffix's (a host's) prior is worth when a host's (its own) counts are added to it.
STRENGTH = 20.0
UNKNOWN = "und"

MARKUP = re.compile(r"<html[^>]*?\s(?:xml:)?lang\s*=\s*[\"']?\s*([A-Za-z]{2,3})\b|<meta[^>]*?content-language[^>]*?content\s*=\s*[\"']?\s*([A-Za-z]{2,3})\b", re.I)


def slots_of(text: str) -> np.ndarray:
    """Hashed trigrams of the lower-cased text's bytes: each three bytes in a row with a letter, by str.isalpha, among their characters (bytes over 127 count as letters)."""
    b = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    letter = (b > 127) | ((b >= 97) & (b <= 122))
    b = np.where(letter, b, 32)
    code = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0x27D4EB2F)
    return (code >> np.uint32(16))[letter[:-2] | letter[1:-1] | letter[2:]]


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # slots x languages, log-probabilities

    def score(self, text: str | None) -> tuple[np.ndarray, int]:
        """Log-likelihood of each language, and trigrams seen; whole texts, in pieces of bounded memory."""
        total, n = np.zeros(len(self.languages)), 0
        for i in range(0, len(text or ""), PIECE):
            slots = slots_of(text[i : i + PIECE])
            total += self.table[slots].sum(axis=0, dtype=np.float64)
            n += len(slots)
        return total, n


def counted(rows: pd.DataFrame) -> pd.DataFrame:
    """Documents and trigram counts of a language's sample; a document counts alike whatever its length, so long ones don't make the model."""
    total = np.zeros(SLOTS)
    for text in rows.sort_values(["mark", "piece"])["piece"]:
        found = np.bincount(slots_of(text), minlength=SLOTS)
        total += found * (1000 / max(1000, found.sum()))
    return pd.DataFrame({"label": [rows["label"].iloc[0]], "n": [len(rows)], "counts": [total]})


def fit(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id") -> Model:
    """Trigram models of all languages that label names, from a bounded sample of their documents; labels that are empty or "und" name none.

    The sample is drawn and counted by tasks, one language in each: the driver holds one row of counts a language, and no text. More than
    MOST_LANGUAGES labels raise a ValueError.
    """
    text_ = F.col(text).cast("string")
    piece = F.substring(text_, F.greatest(F.lit(1), F.floor((F.length(text_) - SAMPLE_CHARS) / 2).cast("int") + 1), F.lit(SAMPLE_CHARS))
    usable = docs.select(F.trim(F.col(label).cast("string")).alias("label"), F.md5(F.coalesce(F.col(key).cast("string"), text_)).alias("mark"), piece.alias("piece"))
    usable = usable.filter((F.col("label") != "") & (F.col("label") != UNKNOWN) & F.col("piece").rlike(r"[A-Za-z]|[^\x00-\x7F]"))
    counts = {r[0]: r[1] for r in usable.groupBy("label").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"{label} names more than {MOST_LANGUAGES} languages")
    # Of a large language's documents about a third more than the sample are drawn before they are ranked.
    keep = ~F.col("label").isin([lang for lang, n in counts.items() if n > 1.3 * SAMPLE_DOCS])
    for lang, n in sorted(counts.items()):
        if n > 1.3 * SAMPLE_DOCS:
            keep = keep | (F.col("label") == lang) & (F.conv(F.substring("mark", 1, 8), 16, 10).cast("double") < 2.0**32 * 1.3 * SAMPLE_DOCS / n)
    drawn = usable.filter(keep).withColumn("place", F.row_number().over(W.partitionBy("label").orderBy("mark", "piece"))).filter(F.col("place") <= SAMPLE_DOCS)
    rows = drawn.groupBy("label").applyInPandas(counted, "label string, n int, counts array<double>").collect()
    if not rows:
        return Model([UNKNOWN], np.zeros((SLOTS, 1), np.float32))
    held, seen = {r.label: r.n for r in rows}, {r.label: np.array(r.counts) for r in rows}
    # Counts are brought to the same total, so that what a language has not shown costs alike in each, however few its documents.
    languages, most = sorted(seen), max(c.sum() for c in seen.values())
    common = sum(seen.values())
    table = np.empty((SLOTS, len(languages)), np.float32)
    for i, lang in enumerate(languages):
        share = seen[lang] / seen[lang].sum()
        if held[lang] < LEAST_DOCS:
            share = (1 - SHARED) * share + SHARED * common / common.sum()
        table[:, i] = np.log((most * share + 0.5) / (most + 0.5 * SLOTS))
    return Model(languages, table)


def scored(model: Model, text: Column, declared: Column) -> Column:
    """Struct of ll (tempered log-likelihoods), n (trigrams) and declared (by the text's markup, else the column given)."""

    @F.pandas_udf("ll array<double>, n long, declared string")
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, said in batches:
            ll, n, tags = [], [], []
            for t, d in zip(texts, said, strict=True):
                t = t if isinstance(t, str) else ""
                total, seen = model.score(t)
                ll.append((total * TEXT_WEIGHT).tolist())
                n.append(seen)
                found = MARKUP.search(t) if "<" in t else None
                tag = (found[1] or found[2]) if found else d
                tags.append(tag.strip().lower()[:2] if isinstance(tag, str) and tag.strip() else None)
            yield pd.DataFrame({"ll": ll, "n": n, "declared": pd.Series(tags, dtype=object)})

    return of(text, declared)


def host_of(url: Column) -> Column:
    """Host of an address, in lower case; of anything else the text itself."""
    return F.lower(F.coalesce(F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")), url))


def suffix_of(host: Column) -> Column:
    """Last label of a host; "" where it has no dot."""
    return F.coalesce(F.regexp_extract(host, r"\.([a-z]{2,})\.?$", 1), F.lit(""))


def family_of(host: Column) -> Column:
    """What a host's prior is smoothed by: its suffix, or for a name without dots the letters it begins with; "" for neither."""
    return F.coalesce(F.nullif(suffix_of(host), F.lit("")), F.when(~host.contains("."), F.regexp_extract(host, r"^([a-z]*)", 1)), F.lit(""))


def argmax(values: Column) -> Column:
    """Place of the first largest value, from 0."""
    return F.array_position(values, F.array_max(values)).cast("int") - 1


def priors(stats: DataFrame, k: int) -> tuple[DataFrame, list[float], DataFrame]:
    """(host, log prior) table, the log prior of all documents, and (declared, log likelihood) table from stats (host, suffix, declared, best, n)."""
    each = [F.coalesce(F.sum(F.when(F.col("best") == i, F.col("n"))), F.lit(0)).cast("double").alias(f"c{i}") for i in range(k)]
    all_counts = stats.agg(*each).first()
    total = sum(all_counts)
    overall = [(c + 1.0) / (total + k) for c in all_counts]

    def smoothed(counts: Column, above: Column) -> Column:
        size = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(counts, above, lambda c, p: (c + F.lit(STRENGTH) * p) / (size + F.lit(STRENGTH)))

    base = F.array(*[F.lit(p) for p in overall])
    counted = lambda df: df.select(*[c for c in df.columns if not re.fullmatch(r"c\d+", c)], F.array(*[F.col(f"c{i}") for i in range(k)]).alias("counts"))
    suffixes = counted(stats.filter("suffix <> ''").groupBy("suffix").agg(*each)).select("suffix", smoothed(F.col("counts"), base).alias("above"))
    hosts = counted(stats.groupBy("host", "suffix").agg(*each)).join(suffixes, "suffix", "left")
    hosts = hosts.select("host", F.transform(smoothed(F.col("counts"), F.coalesce("above", base)), F.ln).alias("prior"))
    # P(declared | language): a declaration is right nine times in ten before anything is counted; one that names no known language says little.
    declared = counted(stats.filter("declared is not null").groupBy("declared").agg(*each))
    of_language = stats.filter("declared is not null").agg(*each).first()
    return hosts, overall, declared.select("declared", F.transform(F.col("counts"), lambda c, i: F.struct(c.alias("c"), i.alias("i"))).alias("counts"), F.array(*[F.lit(float(c or 0)) for c in of_language]).alias("sizes"))


def right_log(counts: Column, sizes: Column, names: Column, k: int) -> Column:
    """Log-likelihood of a declaration under each language, from how often texts of each language declare it."""
    at = lambda x: x["i"].cast("int")
    guess = lambda x: F.when(F.col("declared") == F.get(names, at(x)), F.lit(0.9)).otherwise(F.lit(0.1 / max(1, k - 1)))
    return F.transform(counts, lambda x: F.ln((x["c"] + F.lit(STRENGTH) * guess(x)) / (F.get(sizes, at(x)) + F.lit(STRENGTH))))


def judged(texts: DataFrame, keys: list[str], model: Model, least: float) -> DataFrame:
    """keys, lang, posterior, text_lang, declared, host and kept of texts (keys, text, address, told); see identify()."""
    k = len(model.languages)
    names = F.array(*[F.lit(x) for x in model.languages])
    where = F.coalesce(host_of(F.col("address")), F.lit(""))
    seen = texts.select(*keys, where.alias("host"), scored(model, F.col("text"), F.col("told")).alias("s")).select(*keys, "host", "s.ll", "s.n", "s.declared")
    seen = materialise(seen, "likelihoods")
    best = F.when(F.col("n") > 0, argmax(F.col("ll")))
    stats = seen.select("host", family_of(F.col("host")).alias("suffix"), "declared", best.alias("best")).filter("best is not null").groupBy("host", "suffix", "declared", "best").agg(F.count("*").alias("n"))
    stats = materialise(stats, "language-counts")
    hosts, overall, said = priors(stats, k)
    said = bounded(materialise(said.select(F.col("declared").alias("said"), right_log(F.col("counts"), F.col("sizes"), names, k).alias("told")), "declared"), 60 + 8 * k)
    hosts = bounded(materialise(hosts.select(F.col("host").alias("at"), "prior"), "hosts"), 100 + 8 * k)
    discard(stats)
    joined = seen.join(hosts, F.col("host") == F.col("at"), "left").join(said, F.col("declared") == F.col("said"), "left")
    base = F.array(*[F.lit(float(np.log(p))) for p in overall])
    zeros = F.array(*[F.lit(0.0)] * k)
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    joined = joined.withColumn("score", add(add(F.col("ll"), F.coalesce("prior", base)), F.coalesce("told", zeros)))
    top = F.array_max("score")
    posterior = F.lit(1.0) / F.aggregate(F.col("score"), F.lit(0.0), lambda a, x: a + F.exp(x - top))
    fitted = model.languages != [UNKNOWN]
    sure = (F.col("n") > 0) & (posterior >= least)
    lang = F.when(sure & F.lit(fitted), F.get(names, argmax(F.col("score")))).otherwise(F.lit(UNKNOWN))
    return joined.select(*keys, lang.alias("lang"), F.round(posterior, 6).alias("posterior"), F.coalesce(F.get(names, best), F.lit(UNKNOWN)).alias("text_lang"), "declared", "host", sure.alias("kept"))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str | None = "source", declared: str | None = None, label: str | None = "lang", model: Model | None = None, least: float = 0.5) -> DataFrame:
    """(key, lang, posterior, text_lang, declared, host, kept) for each row.

    text: the column scored whole. host: an address or a host name. declared: a column that names a language, unless the text's own markup
    does; not the label's, which would tell the models what they learned from it. model: fitted by fit() on the label column where it is not given. lang is
    "und", and kept false, for texts without letters (null and empty ones too) and where no language's posterior reaches `least`; any other document is kept.
    Where no label names a language there is no model: every lang is "und", and all texts with letters are kept. Null hosts or declarations are no evidence;
    repeated rows give a row each, a null key stays null, further columns are ignored; an empty table gives no rows.
    """
    model = model or fit(docs, text, label or "lang", key)
    nothing = F.lit(None).cast("string")
    own = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("text"), (F.col(host).cast("string") if host else nothing).alias("address"), (F.col(declared).cast("string") if declared else nothing).alias("told"))
    return judged(own, ["_key"], model, least).withColumnRenamed("_key", key)


def in_known_language(docs: DataFrame, model: Model | None = None, least: float = 0.5) -> DataFrame:
    """docs (doc_id, text, lang, source) in their own columns without those that identify() rejects.

    What it finds depends on text and source alone, so rejected rows are found again by a digest of the text, its length and the source: texts don't travel.
    """
    model = model or fit(docs)
    mark = {"mark": F.xxhash64(F.col("text").cast("string")), "size": F.coalesce(F.length(F.col("text").cast("string")), F.lit(-1)), "from": F.col("source").cast("string")}
    own = docs.select(*[c.alias(n) for n, c in mark.items()], F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("address"), F.lit(None).cast("string").alias("told"))
    out = materialise(judged(own, list(mark), model, least).filter("not kept").select(*[F.col(n).alias(unused(n, docs)) for n in mark]).distinct(), "rejected")
    same = reduce(lambda a, b: a & b, [c.eqNullSafe(F.col(unused(n, docs))) for n, c in mark.items()])
    return docs.join(bounded(out), same, "left_anti").select(*docs.columns)
