import pytest

from gridloom.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(same, name):
    same(name)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_rectangle_joins_are_equality_joins(spark, sf):
    """No nested loops: the band makes them equality joins."""
    for name in ("candidate_cells", "unassigned_cells", "validation_membership", "overlap_pairs"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_components_with_gaps(spark):
    from gridloom.operators.spatial import components

    cells = spark.createDataFrame([("w", "s", r, c) for r, c in ((1, 1), (1, 4), (2, 9), (3, 9), (5, 9), (9, 9))], "workbook string, sheet string, row int, col int")
    boxes = lambda h, v: sorted((r.min_row, r.min_col, r.max_row, r.max_col, r.cells) for r in components(cells, h, v).collect())
    assert boxes(0, 0) == [(1, 1, 1, 1, 1), (1, 4, 1, 4, 1), (2, 9, 3, 9, 2), (5, 9, 5, 9, 1), (9, 9, 9, 9, 1)]
    assert boxes(2, 1) == [(1, 1, 1, 4, 2), (2, 9, 5, 9, 3), (9, 9, 9, 9, 1)]


def test_candidates_grow_over_whole_chains_of_merges(spark):
    """Like the plain loop over merges, with and without the area limit."""
    import random

    from gridloom.plans.detect import snap_to_merges

    def plain(b, merges, limit):
        changed = True
        while changed:
            changed = False
            for m in sorted(merges):
                meets = m[0] <= b[2] and m[2] >= b[0] and m[1] <= b[3] and m[3] >= b[1]
                wide = (min(b[0], m[0]), min(b[1], m[1]), max(b[2], m[2]), max(b[3], m[3]))
                if meets and wide != b and (wide[2] - wide[0] + 1) * (wide[3] - wide[1] + 1) <= limit:
                    b, changed = wide, True
        return b

    rng = random.Random(1)
    chain = [(1 + k, 3 * k, 2 + k, 3 * k + 3) for k in range(1, 12)]  # each is met by the growth over the last
    boxes = {"chain": [(2, 1, 2, 3)], "free": [(50, 50, 60, 60)], "mixed": [(r, c, r + 3, c + 3) for r, c in ((rng.randrange(1, 40), rng.randrange(1, 40)) for _ in range(12))]}
    merges = {"chain": chain, "mixed": [(r, c, r + rng.randrange(1, 6), c + rng.randrange(1, 6)) for r, c in ((rng.randrange(1, 40), rng.randrange(1, 40)) for _ in range(60))], "alone": [(1, 1, 2, 2)]}
    sides = "min_row int, min_col int, max_row int, max_col int"
    cand = spark.createDataFrame([("wb", s, f"{s}{k}", *b, None) for s, v in boxes.items() for k, b in enumerate(v)], f"workbook string, sheet string, candidate string, {sides}, forced boolean")
    given = spark.createDataFrame([("wb", s, *m) for s, v in merges.items() for m in v], f"workbook string, sheet string, {sides}")
    for limit in (1_000_000, 300, 60, 5):
        got = snap_to_merges(cand, given, limit)
        assert got.schema == cand.schema
        want = {f"{s}{k}": plain(b, merges.get(s, []), limit) for s, v in boxes.items() for k, b in enumerate(v)}
        assert {r["candidate"]: (r["min_row"], r["min_col"], r["max_row"], r["max_col"]) for r in got.collect()} == want
    assert plain((2, 1, 2, 3), chain, 1_000_000)[2:] == (13, 36)


def test_nearest_makes_no_pairs(spark, sf):
    """Against brute force, with ties, several rectangles of an id, open sides
    and sheets of one kind only; and no join of a sheet with itself."""
    import random

    from gridloom.operators.spatial import nearest
    from gridloom.queries import QUERIES

    rng = random.Random(3)
    rects = lambda sheets, n, ids: [("w", rng.choice(sheets), rng.randrange(ids), *(r := [rng.randrange(1, 40), rng.randrange(1, 30)]), None if rng.random() < 0.1 else r[0] + rng.randrange(4), r[1] + rng.randrange(4)) for _ in range(n)]
    shape = "workbook string, sheet string, {} long, min_row int, min_col int, max_row int, max_col int"
    notes, tables = rects(["a", "b", "only notes"], 150, 90), rects(["a", "b", "only tables"], 400, 1000)
    notes.append(("w", None, 1, 1, 1, 1, 1))
    tables.append(("w", None, 1, 1, 1, 1, 1))
    end = lambda x: 10**9 if x is None else x
    want = {}
    for w, s, i, r1, c1, r2, c2 in notes:
        for w2, s2, j, q1, d1, q2, d2 in tables:
            if s == s2 and s is not None:
                d = max(0, q1 - end(r2), r1 - end(q2)) + max(0, d1 - c2, c1 - d2)
                best = (d, q1, d1, end(q2), d2, j)
                want[w, s, i] = min(best, want.get((w, s, i), best))
    got = nearest(spark.createDataFrame(notes, shape.format("note")), spark.createDataFrame(tables, shape.format("table_id")), "note", "table_id")
    assert sorted(map(tuple, got.collect())) == sorted((*k, v[-1], v[0]) for k, v in want.items())
    plan = QUERIES["nearest_table"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan
