from collections import defaultdict

import pytest

from pricelake.llm import mixing
from tests.llm.helpers import frame, given_docs, odd_docs


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        if not free:
            break
        level = (total - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not above:
            break
        capped |= above
    return {s: 2.0 * sizes[s] if s in capped else weight[s] * level for s in order}


@pytest.mark.parametrize("rows", [odd_docs(), given_docs()], ids=["odd", "given"])
def test_against_brute_force(spark, rows):
    got = mixing.mix(frame(spark, rows)).collect()
    import re
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = brute_targets(dict(sizes))
    assert len(got) == len(rows)
    taken = defaultdict(int)
    smallest = defaultdict(lambda: 10**9)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        taken[r["source"]] += r["taken"]
        if r["size"]:
            smallest[r["source"]] = min(smallest[r["source"]], r["size"])
    if len(rows) > 100:
        for s in target:
            assert abs(taken[s] - target[s]) <= max(smallest[s], 0.02 * target[s]), s


def test_reruns_agree(spark):
    rows = given_docs()
    one = {(r["doc_id"], r["copies"]) for r in mixing.mix(frame(spark, rows)).collect()}
    two = {(r["doc_id"], r["copies"]) for r in mixing.mix(frame(spark, rows[::-1]).repartition(3)).collect()}
    assert one == two


def test_empty_and_wordless(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    got = mixing.mix(frame(spark, [(1, None, "en", "a", 0), (2, " ", "en", None, 0)])).collect()
    assert {(r["taken"], r["target"]) for r in got} == {(0, 0.0)}
