"""The registered queries over the smallest tables, and the pipeline against the operators' plain versions."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import corpus_pipeline
from tidewatt import session
from tests import oracle
from tests.llm import plain
from tests.llm.test_operators import check_pieces, tokenizer  # noqa: F401
from tidewatt.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")

KEYS = {5: ("documents", "doc_id"), 7: ("documents", "doc_id"), 8: ("documents", "doc_id"), 9: ("pages", "page_id"), 4: ("documents", "doc_id"),
        1: ("documents", "doc_id"), 2: ("documents", "doc_id")}


def test_names():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("n", sorted(KEYS))
def test_one_row_per_input_row(spark, n):
    name = next(q for q in QUERIES if q.startswith(f"op{n}_"))
    table, key = KEYS[n]
    want = sorted(r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect())
    got = QUERIES[name](spark, SF_DIR).collect()
    assert sorted(r[key] for r in got) == want
    if n == 1:
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain.linked(texts)
    if n == 8:
        lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
        held = [r for r in got if r.held_out]
        assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.9 * len(held)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert oracle.compare(spark, oracle.connect(SF_DIR), SF_DIR, name, QUERIES[name], SQL[name]) is None


def test_pipeline(spark, tokenizer, tmp_path, monkeypatch):  # noqa: F811
    """Each stage against a plain version on its own input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = {r.item_id: plain.words(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, SF_DIR)
        assert out.columns == columns, name
        path = str(tmp_path / str(k))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r.doc_id: r for r in docs.collect()}
        texts = {i: r.text for i, r in before.items()}
        if k == 0:
            assert all(plain.counts(r.text)[0] >= 50 for r in after.values()) and after
        if k == 1:
            gone = plain.removed_lines(texts, 2, 30)
            for i, text in texts.items():
                drop = {n for part in gone.get(i, ()) for n in part}
                left = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in drop)
                assert (i in after) == bool(left.strip()) and (i not in after or after[i].text == left)
        if k == 2:
            assert set(after) == {i for i, (_, c) in plain.linked(texts).items() if i == c}
        if k == 3:
            seeds = {(*w[i:i + 5],): n for n, w in benchmark.items() for i in range(len(w) - 4)}
            for i, text in texts.items():
                w = plain.words(text)
                hit = {seeds[g] for g in zip(*(w[j:] for j in range(5))) if g in seeds}
                leak = any(2 * plain.tile_cover(w, benchmark[n], 5) >= len(benchmark[n]) for n in hit)
                assert (i in after) != leak
        before = after
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    check_pieces(got, [(i, r.text) for i, r in before.items()], tokenizer, 2048)
    # The run leaves no scratch table of a stage but what the last one still reads.
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path / "shared"))
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, got))
    left = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "shared").iterdir() if not re.fullmatch(r"[0-9a-f-]{36}", p.name)}
    assert left == {"benchmark-decontamination", "tokens", "quanta", "packets", "rounds"}, left
