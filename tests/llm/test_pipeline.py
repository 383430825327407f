import zlib

import corpus_pipeline as P
from derrick.llm import common, packing
from tests.llm.conftest import EDGE, EDGE_IDS, make
from tests.llm.test_dedup import brute_groups, brute_lines, brute_print
from tests.llm.test_models import brute_hits
from tests.llm.test_tokens import plain

SF = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark, sample):
    rows, df = sample
    stages = dict(P.STAGES)
    assert list(stages) == ["quality_classifier", "line_dedup", "simhash_near_dedup",
                            "benchmark_decontamination", "packing"]
    docs = common.shared_table(stages["quality_classifier"](spark, df, SF))
    assert docs.columns == df.columns and 0.7 * df.count() < docs.count() < df.count()

    before = docs.orderBy("doc_id").collect()
    docs = common.shared_table(stages["line_dedup"](spark, docs, SF))
    gone = brute_lines([(r.doc_id, r.text) for r in before])
    expected = {r.doc_id: "\n".join(x for k, x in enumerate(r.text.split("\n")) if (r.doc_id, k) not in gone)
                for r in before}
    after = docs.orderBy("doc_id").collect()
    assert {r.doc_id: r.text for r in after} == expected and docs.columns == df.columns

    groups = brute_groups([brute_print(r.text) for r in after], [r.doc_id for r in after])
    docs = common.shared_table(stages["simhash_near_dedup"](spark, docs, SF))
    kept = docs.orderBy("doc_id").collect()
    assert [r.doc_id for r in kept] == sorted(set(groups))

    bench = [tuple(r) for r in common.read(spark, SF, "benchmark").select("item_id", "text").collect()]
    clean = [r for r, h in zip(kept, brute_hits([r.text for r in kept], bench)) if not h[4]]
    docs = common.shared_table(stages["benchmark_decontamination"](spark, docs, SF))
    assert sorted(r.doc_id for r in docs.collect()) == [r.doc_id for r in clean]

    pieces = stages["packing"](spark, docs, SF).collect()
    ids = dict(zip([r.doc_id for r in clean], plain(packing.TOKENIZER, [r.text for r in clean])))
    assert sum(p.length for p in pieces) == sum(len(x) // 4 + 1 for x in ids.values())
    for p in pieces:
        x = (ids[p.doc_id] + b"\1\0\0\0")[4 * p.start:4 * (p.start + p.length)]
        assert zlib.crc32(x) == p.ids_crc32
    assert {p.sequence_id for p in pieces} == set(range(len({p.sequence_id for p in pieces})))
    whole = P.run(spark, SF).collect()
    assert sorted((p.doc_id, p.start, p.ids_crc32) for p in whole) == sorted(
        (p.doc_id, p.start, p.ids_crc32) for p in pieces)


def test_stages_take_nulls_and_empty_tables(spark):
    for texts, ids in ((EDGE, EDGE_IDS), ([], [])):
        docs = make(spark, texts, ids)
        for _, stage in P.STAGES:
            docs = common.shared_table(stage(spark, docs, SF))
        assert docs.count() == (0 if not texts else len({r.doc_id for r in docs.collect()}))
