import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.llm import langid, queries


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    train, test = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    out = langid.identify(test.withColumnRenamed("lang", "truth"), host="source", declared=None, model=langid.fit(train))
    rows = out.join(test.select("doc_id", "lang").withColumnRenamed("lang", "truth"), "doc_id").filter(F.col("lang") != "und").collect()
    assert len(rows) > 450 and sum(r.lang == r.truth for r in rows) / len(rows) > 0.97


def test_clean_documents_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert langid.identify(docs).filter("not kept").join(docs.select("doc_id", "text"), "doc_id").filter("text rlike '[a-zA-Z]{3}'").count() == 0


def test_evidence(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    model = langid.fit(docs)
    text = {r.lang: r.text[:400] for r in docs.filter("length(text) > 500").groupBy("lang").agg(F.min_by("text", "doc_id").alias("text")).collect()}
    rows = [(i, text["fr"], "http://a.fr/x", None) for i in range(60)] + [(i, text["de"], "http://b.de/x", None) for i in range(60, 120)]
    rows += [(200, "zq", "https://u@new.fr:80/x", None), (201, "zq", "http://a.fr/y", None), (202, "zq", "http://b.de/y", None), (203, '<html lang="es"><p>zq', None, None), (204, "zq", None, "fr"), (205, None, "http://a.fr", "fr"), (206, "", None, None), (207, "12 34 !?", "http://a.fr", "fr"), (None, text["en"] * 300, None, "??"), (208, text["es"], "http://a.fr/z", "fr")]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, url string, said string"), host="url", declared="said", model=model)
    by = {r.doc_id: r for r in got.collect()}
    assert by[201].lang == "fr" and by[202].lang == "de" and by[200].lang == "fr"  # host, host, suffix
    assert by[203].declared == "es" and by[204].declared == "fr"
    assert by[200].host == "new.fr" and by[203].host == ""
    for i in (205, 206, 207):
        assert by[i].lang == "und" and not by[i].kept
    assert by[None].lang == "en" and by[None].kept
    assert by[208].lang == "es"  # text outweighs a host and a declaration
    prior = {i: by[i].posterior for i in (201, 200)}
    assert prior[201] >= prior[200]


def test_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, _lang int, declared int"
    empty = spark.createDataFrame([], schema)
    assert langid.identify(empty).count() == 0
    rows = [(i, "the and of " * 5, "en", None, 1, 2) for i in range(20)] + [(i, "le la des " * 5, "fr", "s", 1, 2) for i in range(20, 40)] + [(40, "le la", None, None, 1, 2), (40, "le la", None, None, 1, 2)]
    df = spark.createDataFrame(rows, schema)
    assert langid.identify(df).count() == 42
    kept = langid.in_known_language(df)
    assert kept.columns == df.columns and kept.count() == 42
    # Nothing to learn from: there is no model, so what has letters is kept.
    unlabelled = spark.createDataFrame([(1, "x", None, None, 1, 1), (2, "12 !", None, "s", 1, 1), (3, None, "", "s", 1, 1), (4, "é", "und", "s", 1, 1)], schema)
    assert sorted(r.doc_id for r in langid.in_known_language(unlabelled).collect()) == [1, 4]
    assert {(r.doc_id, r.lang, r.kept) for r in langid.identify(unlabelled).collect()} == {(1, "und", True), (2, "und", False), (3, "und", False), (4, "und", True)}


def test_hosts_and_suffixes(spark):
    urls = ["http://A.Example.com/x", "https://u:p@b.org:8080?q", "src7", "", None, "ftp://c.co.uk."]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").select("i", langid.host_of(F.col("u")).alias("h"), langid.suffix_of(langid.host_of(F.col("u"))).alias("s")).orderBy("i").collect()
    assert [r.h for r in rows] == ["a.example.com", "b.org", "src7", "", None, "c.co.uk."]
    assert [r.s for r in rows] == ["com", "org", "", "", "", "uk"]


def test_long_and_few_labelled_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang", "source").filter("length(text) > 200")
    few = [r.doc_id for r in docs.filter("lang = 'fr'").orderBy("doc_id").limit(3).collect()]
    # Three French labels; every German text is longer than the sample takes of one.
    train = docs.filter(F.col("doc_id").isin(few) | (F.col("lang") != "fr")).withColumn("text", F.when(F.col("lang") == "de", F.repeat("text", 120)).otherwise(F.col("text")))
    model = langid.fit(train)
    assert set(model.languages) == {r.lang for r in docs.select("lang").distinct().collect()}
    out = langid.identify(docs.filter(~F.col("doc_id").isin(few)), host=None, declared=None, model=model)
    rows = out.join(docs.select("doc_id", F.col("lang").alias("truth")), "doc_id").collect()
    for lang in model.languages:
        right = [r.lang == lang for r in rows if r.truth == lang]
        assert sum(right) / len(right) > 0.95, lang
    long = docs.filter("doc_id < 50").withColumn("text", F.repeat("text", 120))
    assert langid.in_known_language(long).count() == long.count()
    small = docs.filter("doc_id < 6")
    assert langid.in_known_language(small).count() == small.count() > 0


def brute(rows, model, least=0.5):
    """Verdicts of (key, text, host name, declared) by plain loops over NumPy."""
    k, out = len(model.languages), []
    seen = []
    for key, text, host, said in rows:
        total, n = model.score(text)
        found = langid.MARKUP.search(text or "")
        said = (found[1] or found[2]) if found else said
        seen.append((key, host or "", said.strip().lower()[:2] if said else None, total * langid.TEXT_WEIGHT, n))
    family = lambda h: h.rsplit(".", 1)[1] if "." in h else "".join(c for c in h if c.isalpha())
    of_all, of_family, of_host, of_said = Counter(), {}, {}, {}
    for _, host, said, ll, n in seen:
        if n:
            best = int(np.argmax(ll))
            of_all[best] += 1
            of_family.setdefault(family(host), Counter())[best] += 1
            of_host.setdefault(host, Counter())[best] += 1
            if said:
                of_said.setdefault(said, Counter())[best] += 1
    smooth = lambda c, above: [(c[i] + langid.STRENGTH * above[i]) / (sum(c.values()) + langid.STRENGTH) for i in range(k)]
    base = [(of_all[i] + 1) / (sum(of_all.values()) + k) for i in range(k)]
    for key, host, said, ll, n in seen:
        above = smooth(of_family.get(family(host), Counter()), base) if family(host) else base
        score = ll + np.log(smooth(of_host[host], above) if host in of_host else base)
        if said and any(said == s for s in of_said):
            sizes = [sum(c[i] for c in of_said.values()) for i in range(k)]
            score = score + [math.log((of_said[said][i] + langid.STRENGTH * (0.9 if said == model.languages[i] else 0.1 / (k - 1))) / (sizes[i] + langid.STRENGTH)) for i in range(k)]
        posterior = 1 / np.exp(score - score.max()).sum()
        kept = n > 0 and posterior >= least
        out.append((key, model.languages[int(np.argmax(score))] if kept else "und", round(float(posterior), 6), kept))
    return out


def test_posteriors_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    model = langid.fit(docs)
    cut = [(r.doc_id, (f'<html lang="{r.lang if r.doc_id % 7 else "en"}">' if r.doc_id % 3 == 0 else "") + r.text[: 3 + r.doc_id % 40], None if r.doc_id % 11 == 0 else f"h{r.doc_id % 5}.{r.lang}" if r.doc_id % 2 else r.source, r.lang if r.doc_id % 4 == 0 else None) for r in docs.collect()]
    cut += [(5000, None, "h1.en", "fr"), (5001, "", "src3", None), (5002, "123", None, "xx")]
    df = spark.createDataFrame(cut, "doc_id long, text string, source string, said string")
    got = {r.doc_id: (r.lang, r.posterior, r.kept) for r in langid.identify(df, declared="said", model=model).collect()}
    want = brute(cut, model)
    close = [abs(got[d][1] - p) < 2e-6 and (got[d][0], got[d][2]) == (lang, kept) for d, lang, p, kept in want]
    assert len(got) == len(want) and all(close)
    assert len({p for _, _, p, _ in want}) > 100  # not all of them certain


def test_the_query_over_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text, r.source, None) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.lang, r.posterior, r.kept) for r in queries.op5_language_evidence(spark, sf_dir).collect()}
    for d, lang, p, kept in brute(rows, langid.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))):
        assert (got[d][0], got[d][2]) == (lang, kept) and abs(got[d][1] - p) < 2e-6


def test_pages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    text = {r.lang: r.text[:500] for r in docs.filter("length(text) > 600").groupBy("lang").agg(F.min_by("text", "doc_id").alias("text")).collect()}
    rows = [(1, "http://a.example.fr/x", f'<html lang="fr"><p>{text["fr"]}'), (2, None, None), (3, "", ""), (None, "http://b.de", f"<p>{text['de']}"), (4, "https://b.de/2", f"<p>{text['de']}"), (4, "https://b.de/2", f"<p>{text['de']}"), (5, "x", "<1>"), (6, "http://c.com", text["en"] * 400)]
    spark.createDataFrame([(*r, "en", 1) for r in rows], "page_id long, url string, html string, lang string, host int").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(((r.page_id or -1, r.lang, r.kept) for r in queries.language_of_pages(spark, str(tmp_path)).collect()))
    assert got == [(-1, "de", True), (1, "fr", True), (2, "und", False), (3, "und", False), (4, "de", True), (4, "de", True), (5, "und", False), (6, "en", True)]


def test_columns_of_any_name_keep_their_values(spark):
    names = ["_lang", "_host", "_s", "_prior", "_key", "mark", "size", "from", "host", "ll", "n", "kept", "at", "said"]
    rows = [(i, "the and of " * 5 if i % 2 else "12 !", "en", "s", *[f"{n}{i}" for n in names]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in names))
    out = langid.in_known_language(df)
    assert out.columns == df.columns and sorted(map(tuple, out.collect())) == [r for r in rows if r[0] % 2]


def test_labels_that_are_no_languages_are_refused(spark):
    df = spark.range(langid.MOST_LANGUAGES + 5).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.concat(F.lit("l"), F.col("id").cast("string")).alias("lang"), F.lit("s").alias("source"))
    with pytest.raises(ValueError, match="languages"):
        langid.fit(df)
