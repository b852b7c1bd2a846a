import random
from collections import defaultdict

import corpus_pipeline
from ledgerline.llm import line_dedup


def test_short_lines_are_compared(spark, tmp_path):
    """The query and the stage against all pairs, on lines of one to seven words."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(12)]
    rows = [(d, "\n".join([*(" ".join(rng.choices(words, k=rng.randint(1, 7))) for _ in range(6)), "", "---", "Menu"])) for d in range(60)]
    rows += [(100, "a b c d"), (101, "e d c b a"), (102, "p q r s t"), (103, "s r q p"), (104, "k l m"), (105, "k l m n"), (106, "M, l; K")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    sets = sorted(((d, k), {*line.lower().replace(",", "").replace(";", "").split()}) for d, t in rows for k, line in enumerate(t.split("\n")) if line not in ("", "---"))
    want = defaultdict(set)
    for i, (key, a) in enumerate(sets):
        for other, b in sets[:i]:
            if len(a & b) >= 0.8 * len(a | b) - 1e-9:
                want[key].add(other)
    # Four words match five; three don't match four.
    assert {(101, 0), (103, 0), (106, 0)} <= want.keys() and not {(104, 0), (105, 0)} & want.keys()
    got = {(r.doc_id, r.line_no): (r.match_doc_id, r.match_line_no) for r in line_dedup.op2_line_dedup(spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys()
    assert all(match in want[key] for key, match in got.items())
    left = corpus_pipeline.dedup_lines(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
    assert {r.doc_id: r.text for r in left.collect()} == {d: "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in want) for d, t in rows}
