import hashlib
import io
import random
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing, warc
from ledgerline.llm.common import scratch_path

DOCS = "doc_id bigint, text string, source string, n_chars bigint"


def documents(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 90)), rng.choice(["a"] * 6 + ["b", "c", "é", "Z", None]), 0) for i in range(3000)]
    rows += [(5000, None, "a", 0), (5001, "", "only empty", 0), (None, "x y z", "b", None), (6000, "w w", "a", 0), (6000, "w w", "a", 0), (5002, "w " * 100_000, "c", 0)]
    return spark.createDataFrame(rows, DOCS), rows


def brute_targets(sizes):
    """Shares by weight; what exceeds three times a size is shared anew, until none does."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3 * sizes[s] for s in over}


def test_targets_equal_brute_force(spark):
    rng = random.Random(1)
    for _ in range(6):
        sizes = {s: rng.choice([0, 1, 10, 1000, 10**6, rng.randrange(10**4)]) for s in rng.sample(["a", "b", "B", "é", "zz", None, "d", "e"], rng.randint(1, 8))}
        df = spark.createDataFrame([(s or "n", s, n) for s, n in sizes.items()], "__key string, source string, source_size bigint")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        assert got == pytest.approx(brute_targets(sizes))


def test_mix_meets_targets_and_is_repeatable(spark):
    docs, rows = documents(spark)
    planned = mixing.plan(docs.repartition(3)).select("doc_id", "source", "__size", "__source_size", "__target", "__shards").collect()
    assert len(planned) == len(rows)
    by, texts = {}, {x[0]: x[1] for x in rows}
    for r in planned:
        assert r["__size"] == len((texts[r.doc_id] or "").split()) and len(r["__shards"]) <= 3
        s = by.setdefault(r.source, [0, r["__target"], r["__source_size"], 0])
        s[0] += r["__size"] * len(r["__shards"])
        s[3] = max(s[3], r["__size"])
    want = brute_targets({s: v[2] for s, v in by.items()})
    for s, (taken, target, size, longest) in by.items():
        assert target == pytest.approx(want[s]) and abs(taken - target) <= longest
    again = mixing.plan(docs.repartition(11)).select("doc_id", "source", "__size", "__source_size", "__target", "__shards").collect()
    assert sorted(map(str, again)) == sorted(map(str, planned))
    used = {s for r in planned for s in r["__shards"]}
    assert used <= set(range(8)) and len(used) > 4


def test_equal_rows_are_drawn_in_part(spark):
    """Rows without doc_id, or with the same one, count one by one where a quota ends."""
    rows = [(None, "w " * 10, "a", 0)] * 3000 + [(i, "w " * 50, "b", 0) for i in range(2000)] + [(7, "w " * 9, "c", 0)] * 500 + [(None, f"w {i}", "d", 0) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    takes = []
    for seed, parts in ((1, 5), (1, 2), (2, 5)):
        planned = mixing.plan(docs.repartition(parts), seed=seed)
        by = planned.groupBy("source").agg(F.sum(F.col("__size") * F.size("__shards")).alias("taken"), F.first("__target").alias("target"), F.max("__size").alias("longest"), F.count("*").alias("n"))
        for r in by.collect():
            assert abs(r.taken - r.target) <= r.longest, r
        takes.append(sorted((str(r.doc_id), r.source, str(r.text), len(r["__shards"]), *r["__shards"]) for r in planned.collect()))
        assert len(takes[-1]) == len(rows)
    assert [t[:4] for t in takes[0]] == [t[:4] for t in takes[1]]
    assert sum(a[:4] != b[:4] for a, b in zip(takes[0], takes[2])) > 50


def test_shards_draw_what_the_leaves_say(spark):
    """Each shard draws as many blocks of a source as its leaf has, and no block twice in a copy."""
    docs, _ = documents(spark)
    facts = mixing._facts(docs.select("doc_id", "source", "text"))
    sources = {r["__key"]: r for r in mixing._source_rows(facts.select("__key", "source", "__slot", "__size"), 3, mixing.WEIGHTS, 1).collect()}
    seen = {}
    for r in mixing.plan(docs.withColumn("own", F.lit(1))).join(facts.select("doc_id", "__slot", "__key").distinct(), "doc_id").collect():
        for copy, shard in enumerate(r["__shards"]):
            home = seen.setdefault((r["__key"], copy, r["__slot"] // 1024), shard)
            assert home == shard
    for key, source in sources.items():
        assert sorted(source["__places"][:64]) == list(range(64))
        ends = [0, *source["__ends"]]
        for shard in range(8):
            assert sum(k[0] == key and s == shard for k, s in seen.items()) <= ends[shard + 1] - ends[shard]


def test_tree_deals_out_exact_quotas(spark):
    quotas = {"a": 500, "b": 37, "c": 1, "d": 0}
    df = spark.createDataFrame(list(quotas.items()), "__key string, n int")
    dealt = mixing.split_quotas(df, 3, 1).collect()
    for key, n in quotas.items():
        assert sum(r.n for r in dealt if r["__key"] == key) == n
    for shard in range(8):
        assert abs(sum(r.n for r in dealt if r.shard == shard) - sum(quotas.values()) / 8) <= 1
    # Draws, not an even split: seeds differ, and a source's spread is that of the distribution.
    draws = [[r.n for r in mixing.split_quotas(df, 1, seed).collect() if r["__key"] == "b" and r.shard == 0][0] for seed in range(5)]
    assert len(set(draws)) > 1 and 9 < sum(draws) / len(draws) < 28


def test_mix_rows_keep_columns(spark):
    docs, rows = documents(spark)
    docs = docs.selectExpr("*", "'x' as __size", "1 as mix_copy", "2 as __key", "3 as __row")
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "mix_shard", "mix_place"]
    planned = mixing.plan(documents(spark)[0]).agg(F.sum(F.size("__shards"))).first()[0]
    assert mixed.count() == planned
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixing_equals_its_sql(spark, duck):
    columns, want = duck(mixing.OP9_SQL, "/root/testdata/sf0.01")
    got = mixing.op9_mixing(spark, "/root/testdata/sf0.01")
    assert got.columns == columns and sorted(map(tuple, got.collect())) == sorted(want)


def test_no_python_on_the_native_path(spark):
    plan = mixing.op9_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


# WARC


def reader(data):
    return (lambda at, n: data[at : at + n]), len(data)


def packed(compress_index=False, force64=False, head=b"", comment=b"", index=True):
    out = io.BytesIO()
    records = [warc.record(i, f"http://h/{i}", b"p" * (i * 50), hashlib.sha256(b"p" * (i * 50)).hexdigest(), "response", None) for i in range(5)]
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        archive.comment = comment
        with archive.open("archive/data.warc.gz", "w", force_zip64=force64) as member:
            member.write(b"".join(records))
        archive.writestr("pages/pages.jsonl", "{}")
        if index:
            at, lines = 0, []
            for r in records:
                lines.append(f'h/ 2024 {{"filename": "data.warc.gz", "offset": "{at}", "length": "{len(r)}"}}')
                at += len(r)
            archive.writestr("indexes/index.cdxj", "\n".join(lines) + "\n\n", zipfile.ZIP_DEFLATED if compress_index else zipfile.ZIP_STORED)
    return head + out.getvalue()


@pytest.mark.parametrize("case", [{}, {"compress_index": True}, {"force64": True}, {"head": b"junk" * 9}, {"comment": b"PK\5\6 a comment"}, {"index": False}])
def test_archives_are_read_by_range(case):
    data = packed(**case)
    got = [warc.parse(data[at : at + n]) for at, n in warc.places(*reader(data))]
    assert [(r["page_id"], r["payload_bytes"], r["payload"]) for r in got] == [(i, i * 50, b"p" * (i * 50)) for i in range(5)]


def zip64(data):
    """The same archive with its end of directory in ZIP64 form."""
    import struct

    start, length, _ = warc.end_of_directory(*reader(data))
    entries = struct.unpack_from("<H", data, len(data) - 12)[0]
    end = struct.pack("<4sQ2H2L4Q", b"PK\6\6", 44, 45, 45, 0, 0, entries, entries, length, start)
    locator = struct.pack("<4sLQL", b"PK\6\7", 0, start + length, 1)
    return data[: start + length] + end + locator + struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)


@pytest.mark.parametrize("head", [b"", b"stub"])
def test_zip64_directory(head):
    data = head + zip64(packed())
    assert len([warc.parse(data[at : at + n]) for at, n in warc.places(*reader(data))]) == 5


def test_broken_archives_are_refused():
    data = packed()
    for bad in (b"", b"nothing", data[:-30], data[: len(data) // 2]):
        with pytest.raises(ValueError):
            list(warc.places(*reader(bad)))
    at, n = next(warc.places(*reader(data)))
    record = warc.record(1, "u", b"x" * 200, "0" * 64, "response", None)
    with pytest.raises(ValueError, match="digest"):
        warc.parse(record)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("archive/data.warc.gz", b"x" * 100)
    with pytest.raises(ValueError, match="not stored"):
        list(warc.places(*reader(out.getvalue())))


@pytest.mark.parametrize("extra", [b"\1\0\4\0abcd", b"\1\0\x10\0abcd", b"\1\0\x08\0" + b"\0" * 8])
def test_cut_off_zip64_fields_are_refused(extra):
    name = b"archive/a.warc"
    local = b"PK\3\4" + struct.pack("<5H3L2H", 45, 0, 0, 0, 0, 0, 0, 0, len(name), 0) + name
    central = b"PK\1\2" + struct.pack("<6H3L5H2L", 45, 45, 0, 0, 0, 0, 0, 2**32 - 1, 2**32 - 1, len(name), len(extra), 0, 0, 0, 0, 0) + name + extra
    data = local + central + b"PK\5\6" + struct.pack("<4H2LH", 0, 0, 1, 1, len(central), len(local), 0)
    with pytest.raises(ValueError, match="ZIP64"):
        list(warc.places(*reader(data)))


def test_pages_survive_the_round_trip(spark):
    same, short = "<p>same</p>" * 20, "<p>short</p>"
    rows = [(5, "u5", same), (3, "u\r\n3", same), (9, None, same), (1, "u1", short), (2, "u2", short), (4, "u4", None), (6, "u6", ""), (7, "ü?x=1 2", "日本" * 60), (8, "u8", "日本" * 60), (None, "n", same), (None, "n", "y" * 200), (None, "n", "y" * 200), (10, "u10", "z\r\n\r\n" * 200_000), (3, "u3", same)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as digest", "2 as path")
    folder = scratch_path(spark, "test-warc")
    got = warc.read_archives(warc.write_archives(warc.with_types(pages), folder), folder, payloads=True).collect()
    assert len(got) == len(rows)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        revisit = len(data) >= 100 and ids and i != min(ids)
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", min(ids) if revisit else None, None if revisit else data))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got), key=key) == sorted(want, key=key)
    empty = scratch_path(spark, "test-warc")
    assert warc.read_archives(warc.write_archives(warc.with_types(pages.limit(0)), empty), empty).count() == 0


def test_pages_equal_the_sql(spark, duck):
    columns, want = duck(warc.OP10_SQL, "/root/testdata/sf0.01")
    got = warc.op10_warc(spark, "/root/testdata/sf0.01")
    assert got.columns == columns and sorted(map(tuple, got.collect())) == sorted(want)
