import sys
from pathlib import Path

import public_tokenizers
from helpers import ODD, documents, with_clashes, words
from test_quality_rules import counts
from test_simhash import groups, plain
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    import corpus_pipeline as P
    from aerocast.llm.common import stage_table
    from aerocast.llm.secret_scan import redact, scan
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = [docs]
    for name, stage in P.STAGES:
        at.append(stage_table(stage(spark, at[-1], SF), f"test-{name}"))
    rows = [{r.doc_id: r for r in d.collect()} for d in at]
    assert all(d.columns == docs.columns for d in at[:-1])
    for i, r in rows[0].items():
        n, _, _, _, _, rep = counts(r.text)
        if n < 50 or 2 * rep > n:
            assert i not in rows[1]
    ids = sorted(rows[1])
    fp = [plain(rows[1][i].text) for i in ids]
    assert sorted(rows[2]) == [ids[k] for k, g in enumerate(groups(fp)) if g == k]
    assert {i: r.text for i, r in rows[3].items()} == {i: redact(r.text, scan(r.text)) for i, r in rows[2].items()}
    assert set(rows[4]) <= set(rows[3]) and all(rows[4][i] == rows[3][i] for i in rows[4])
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, r in rows[5].items():
        assert r.ids == library.encode(rows[4][i].text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)
    assert at[5].count() == at[4].count()


def test_edge_cases(spark):
    import corpus_pipeline as P
    for rows in (ODD, [], [(i, words(70, 100 * i), None, None) for i in range(4)]):
        docs = with_clashes(documents(spark, rows))
        for _, stage in P.STAGES[:-1]:
            docs = stage(spark, docs, "")
            assert docs.columns == with_clashes(documents(spark, [])).columns
        assert P.STAGES[-1][1](spark, docs, "").count() == docs.count()


def test_registered():
    import __spark_entry__ as E
    names = E.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(E.oracle_sql()) <= set(names)
