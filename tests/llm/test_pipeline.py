import random

from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from ledgerline.llm import decontamination, quality_classifier
from test_duplicates import brute_fingerprint, brute_lines, groups_of


def write(spark, path, docs, labels, benchmark):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def corpus(spark):
    rng = random.Random(33)
    words = ["stone", "river", "green", "walk", "the", "of", "and", "morning", "cold", "light", "bridge", "seven"] + [f"{a}{b}" for a in ("bar", "sel", "tin", "mor") for b in ("ine", "and", "oth", "ule", "est")]
    sentence = lambda k: " ".join(rng.choices(words, k=k))
    rows = [(i, "\n".join(sentence(rng.randint(8, 25)) for _ in range(rng.randint(1, 5))), "en", f"s{i % 4}", 0) for i in range(400)]
    rows[50] = (50, rows[3][1], "en", "s1", 0)  # copy
    passage = sentence(30)
    rows[60] = (60, rows[60][1] + "\n" + passage, "en", "s0", 0)  # leak
    rows[70] = (70, "### $$$ &&& %%% " * 30, "en", "s2", 0)  # junk
    rows += [(900, None, None, None, None), (901, "", "en", "s0", 0), (None, sentence(20), None, None, 0), (5, rows[5][1], "en", "s1", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").selectExpr("*", "1 as row", "2 as kept", "3 as hits", "4 as fp")
    return docs, [(i, 1, 0) for i in range(300) if i != 70], [(1, passage), (2, None)]


def test_stages_do_what_they_say(spark, tmp_path):
    docs, labels, benchmark = corpus(spark)
    sf_dir = write(spark, tmp_path, docs, labels, benchmark)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = spark.read.parquet(f"{tmp_path}/{k - 1}" if k else f"{sf_dir}/documents.parquet")
        stage(spark, before, sf_dir).write.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert spark.read.parquet(f"{tmp_path}/{k}").columns == docs.columns
    read = [spark.read.parquet(f"{tmp_path}/{k}") for k in range(5)]
    ids = [[r.doc_id for r in d.select("doc_id").collect()] for d in read]
    assert not {70, 900, 901} & {*ids[0]} and len(ids[0]) >= 0.98 * docs.count() - 4
    assert sorted(map(str, ids[0])) == sorted(map(str, ids[1]))
    text = {r.doc_id: r.text for r in read[1].collect()}
    assert 50 not in ids[0] or not text[50].strip()  # all lines of the copy are gone
    assert ids[2].count(5) <= 1 and len(ids[2]) == len({*ids[2]})
    assert 60 not in ids[3] and {*ids[2]} - {*ids[3]} == {60}
    assert {*ids[4]} <= {*ids[3]} and len(ids[4]) > 0.5 * len(ids[3])


def test_stages_use_their_operators(spark, tmp_path):
    """Each stage against the plain form of its operator, on its own input."""
    docs, labels, benchmark = corpus(spark)
    sf_dir = write(spark, tmp_path, docs, labels, benchmark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1")
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    kept = quality_classifier.fit(docs, trusted).judge(docs, ["doc_id"]).filter("kept").select("doc_id")
    assert same(kept, corpus_pipeline.keep_quality(spark, docs, sf_dir).select("doc_id"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    gone = brute_lines(rows, least_words=1)
    assert len(gone) > 3
    left = sorted(map(str, ((r.doc_id, r.text) for r in corpus_pipeline.dedup_lines(spark, docs, sf_dir).collect())))
    stays = lambda d, t: t if d is None or t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone)
    assert left == sorted(str((d, stays(d, t))) for d, t in rows)
    prints = {t: brute_fingerprint(t) for _, t in rows}
    distinct = sorted({*prints.values()})
    home = groups_of([(a, b) for i, b in enumerate(distinct) for a in distinct[:i] if (a ^ b).bit_count() <= 2], distinct)
    first = {}
    for d, t in rows:
        group = home[prints[t]]
        first[group] = min(first.get(group, (2**63, "")), (2**63 - 1 if d is None else d, str(d)))
    dropped = corpus_pipeline.dedup_documents(spark, docs, sf_dir)
    assert sorted(str(r.doc_id) for r in dropped.collect()) == sorted(x[1] for x in first.values())
    hit = decontamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ["doc_id"]).filter(F.size("hits") > 0)
    assert [r.doc_id for r in hit.collect()] == [60]


def test_empty_tables_pass_through(spark, tmp_path):
    docs, labels, benchmark = corpus(spark)
    sf_dir = write(spark, tmp_path, docs.limit(0), labels[:0], benchmark[:0])
    assert corpus_pipeline.run(spark, sf_dir).count() == 0


def test_all_queries_are_registered(spark):
    names = contract.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert {*contract.oracle_sql()} <= {*names}
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 50


def test_first_stage_counts_every_trusted_text(spark, tmp_path, monkeypatch):
    """More trusted texts than the sample that hashes once chose."""
    n = 16_000
    rows = spark.range(n).selectExpr("id as doc_id", "concat('text ', id) as text", "'en' as lang", "'a' as source", "0L as n_chars")
    labels = spark.range(n).selectExpr("id as doc_id", "1 as quality")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    seen, own = [], quality_classifier.count_ngrams
    monkeypatch.setattr(quality_classifier, "count_ngrams", lambda df, *rest: (seen.append(df.count()), own(df, *rest))[1])
    kept = corpus_pipeline.keep_quality(spark, rows, str(tmp_path)).count()
    held = labels.filter(F.pmod(F.xxhash64(F.lit(31), "doc_id"), F.lit(quality_classifier.HELD)) == 0).count()
    assert seen == [n - held] and n - held > 12_000 and kept > 0.9 * n
