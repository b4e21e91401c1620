import hashlib
import re
from collections import Counter, defaultdict

import pytest

from smelter.llm.mixing import mix, repetitions, targets
from smelter.llm.shared import small_side

WEIGHTS, LIMIT = (5, 2, 1), 3


def shared_out(sizes):
    """Targets by repeated capping; ``sizes`` in order of the sources."""
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(sizes)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s: float(LIMIT * sizes[s]) for s in free if share[s] > LIMIT * sizes[s]}
        if not over:
            return capped | share
        capped |= over


def source_sizes(corpus):
    sizes = Counter()
    for _, text, _, source, _ in corpus:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    return {s: sizes[s] for s in sorted(sizes, key=lambda s: (s is None, s or ""))}


def test_targets_share_the_total_and_stop_at_the_limit(docs, corpus):
    expected = shared_out(source_sizes(corpus))
    found = {(r["source_size"], round(r["target"], 6)) for r in repetitions(docs).collect()}
    assert found == {(size, round(expected[s], 6)) for s, size in source_sizes(corpus).items()}


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1000, "c": 1000}, {"a": 0, "b": 5}, {"a": 10}, {"a": 1, "b": 1, "c": 1, "d": 1, "e": 100}, {"a": 3, "b": 9, "c": 100, None: 2}])
def test_excess_is_shared_out_again(spark, sizes):
    rows = targets(spark.createDataFrame(list(sizes.items()), "source STRING, size LONG")).collect()
    assert {r["source"]: r["target"] for r in rows} == pytest.approx(shared_out(sizes))


def test_documents_are_taken_by_rate_and_hash(docs, corpus):
    for r in repetitions(docs).collect():
        rate = r["target"] / r["source_size"]
        digest = hashlib.md5(f"{'null' if r['doc_id'] is None else r['doc_id']}:mix".encode()).hexdigest()
        copies = int(rate) + (int(digest[:13], 16) / 2**52 < rate - int(rate))
        assert r["taken"] == r["size"] * copies and copies <= 3


def test_the_mix_has_the_documents_as_often_as_planned(docs, clashing):
    planned = Counter()
    for r in repetitions(docs).collect():
        planned[r["doc_id"]] += r["copies"]
    mixed = mix(clashing(docs))
    assert mixed.columns == clashing(docs).columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == +planned


def test_every_source_comes_near_its_target(spark):
    rows = [(i, "w " * (1 + i % 40), f"s{i % 5}") for i in range(4000)]
    sums = defaultdict(int)
    for r in repetitions(spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")).collect():
        sums[r["doc_id"] % 5, r["target"]] += r["taken"]
    assert len(sums) == 5 and all(abs(taken - target) < 0.2 * target for (_, target), taken in sums.items())


def test_an_empty_table_gives_an_empty_mix(no_docs):
    assert mix(no_docs).collect() == [] == repetitions(no_docs).collect()


def test_very_many_sources_join_without_a_broadcast(spark, monkeypatch):
    """One source has a third of the documents, the others one each; a null one is among them."""
    monkeypatch.setattr(small_side, "__defaults__", (50,))
    rows = [(i, "w " * (1 + i % 7), "hot" if i % 3 == 0 else None if i == 1 else f"s{i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")
    expected = shared_out({s: sum(1 + i % 7 for i, _, x in rows if x == s) for s in sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))})
    mixed, sources = repetitions(docs), {i: s for i, _, s in rows}
    assert "strategy=broadcast" not in mixed._jdf.queryExecution().optimizedPlan().toString()
    found = mixed.collect()
    assert len(found) == 600 and all(r["target"] == pytest.approx(expected[sources[r["doc_id"]]]) for r in found)
    assert mix(docs).count() == sum(r["copies"] for r in found)
