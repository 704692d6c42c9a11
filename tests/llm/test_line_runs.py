"""Repeated line runs against brute force over all runs."""

import numpy as np

from opsward.llm import line_chunks, line_runs
from opsward.llm.queries import QUERIES


def brute_force(rows):
    """Numbers of the lines to remove per document: all runs of all lengths at all places."""
    docs = sorted(set(rows), key=lambda r: (r[0] is not None, r[0]))
    lines = {d: (d[1] or "").split("\n") for d in docs}
    seen, gone = set(), {d: set() for d in docs}
    for d in docs:
        for first in range(len(lines[d])):
            for stop in range(first + 1, len(lines[d]) + 1):
                run = tuple(lines[d][first:stop])
                if len(run) > 1 or len(run[0].split(" ")) >= 50:
                    if run in seen:
                        gone[d] |= set(range(first, stop))
                    seen.add(run)
    return lines, gone


def test_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    pool = ["", "a", "b b", *(" ".join(f"w{i}x{k}" for k in range(n)) for i, n in enumerate([10, 15, 20, 30, 49, 50, 60]))]
    rows = [(i, "\n".join(rng.choice(pool, rng.integers(1, 9)))) for i in range(80)] + [(None, None), (None, "n\nm"), (90, ""), (91, None)]
    rows += [(200 + i, "\n".join(f"{i} {k} {'own ' * 12}" for k in range(6))) for i in range(20)] + rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # Rows with one id and different texts order by digest; the null ids' texts share no run.
    lines, gone = brute_force(rows)
    text = {d: "\n".join(t for i, t in enumerate(own) if i not in gone[d]) for d, own in lines.items()}
    got = [tuple(r) for r in line_runs.dedupe_line_runs(docs).collect()]
    assert sorted(got, key=repr) == sorted(((d[0], len(lines[d]), len(gone[d]), text[d]) for d in rows), key=repr)
    assert {t for own in lines.values() for t in own} == {t for r in got for t in r[3].split("\n")}
    assert line_runs.dedupe_line_runs(docs.limit(0)).count() == 0


def test_short_passages_between_foreign_lines_go(spark):
    """Passages of 2 x 30, 3 x 20, 4 x 15 and 6 x 10 words in two texts: chunks miss most of them, runs miss none."""
    rows = []
    for i in range(120):
        n, words = [(2, 30), (3, 20), (4, 15), (6, 10)][i % 4]
        passage = [" ".join(f"p{i}l{k}w{w}" for w in range(words)) for k in range(n)]
        rows += [(2 * i + j, "\n".join([f"before {i} {j}", *passage, f"after {i} {j}"])) for j in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in line_runs.dedupe_line_runs(docs).collect()}
    for i in range(120):
        assert got[2 * i].removed_lines == 0 and got[2 * i + 1].text == f"before {i} 1\nafter {i} 1"
    assert line_chunks.dedupe_lines(docs).where("removed_lines > 0").count() < 120
