"""Line dedup against plain Python, also where lines cross the ends of tasks."""

import random
from collections import defaultdict

import pandas as pd
import pytest

from vertexloom.llm.line_dedup import DROP, EDGE, PENDING, _stream, dedup_lines

SPACES = " \t\n\x0b\x0c\r"


def plain(rows, least):
    docs = defaultdict(set)
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))
    for n, (i, t, _) in enumerate(rows):
        for line in (t or "").split("\n"):
            docs[key(line)].add((i, t))
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or len(docs[key(x)]) < least]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_against_plain_python(documents, awkward):
    rng = random.Random(4)
    pool = [f"line {i} Ä" for i in range(30)] + ["LINE 3 Ä ", "", "  "]
    rows = [(100 + i, "\n".join(rng.choices(pool, k=rng.randint(0, 12))), "s") for i in range(60)] + awkward
    got = dedup_lines(documents(rows), min_documents=10)
    out = [(r["row"]["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()]
    assert sorted(out, key=str) == plain(rows, 10)
    assert dedup_lines(documents(rows).limit(0)).count() == 0


@pytest.mark.parametrize("batch", [1, 3, 1000])
@pytest.mark.parametrize("cuts", [[], [7], [5, 11, 12, 40]])
def test_stream_settles_lines_over_tasks(batch, cuts):
    rng = random.Random(batch)
    rows = sorted({(rng.randint(0, 6), 0, rng.randint(0, 9), 0, rng.randint(0, 1)) for _ in range(90)})
    # a task begins where a document of a line does
    cuts = [c for c in cuts if c < len(rows) and rows[c][:4] != rows[c - 1][:4]]
    tasks = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    marks = []
    for task in tasks:
        frame = pd.DataFrame(task, columns=["h1", "h2", "_k1", "_k2", "pos"])
        parts = (frame.iloc[i : i + batch] for i in range(0, len(frame), batch))
        marks += [tuple(r) for out in _stream(6)(parts) for r in out.itertuples(index=False)]
    totals = defaultdict(int)
    for m in marks:
        totals[m[:2]] += m[5] if m[6] == EDGE else 0
    dropped = {m[:5] for m in marks if m[6] == DROP or m[6] == PENDING and totals[m[:2]] >= 6}
    docs = defaultdict(set)
    for r in rows:
        docs[r[:2]].add(r[2:4])
    assert dropped == {r for r in rows if len(docs[r[:2]]) >= 6}
