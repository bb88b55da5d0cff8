"""Steering files read on: appended, replaced, shrunk and gone ones are told apart."""

import pytest

from tickloom.sources import steering
from tickloom.sources.staging import staged


def lines(*days):
    return "".join(f"{60_000 + d}.250000 {d} -1e-3\n" for d in days)


def test_files_are_read_on_from_where_they_were(spark, tmp_path):
    put = lambda ref, text: (tmp_path / f"steer_{ref}.dat").write_bytes(text.encode("latin-1"))
    events, known = spark.createDataFrame([], "ref string, applied_us long, dx double, dy double"), None

    def step():
        nonlocal events, known
        changes, state = steering.increment(spark, str(tmp_path), known)
        changes, known = staged(changes, "changes"), staged(state, "state")
        events = staged(steering.applied(events, changes), "events")
        whole = {tuple(r) for r in steering.read(spark, str(tmp_path)).collect()}
        assert {tuple(r) for r in events.collect()} == whole
        return sorted((r.ref, r.action, r.dx) for r in changes.collect())

    for ref, days in (("mc1", (1, 2)), ("mc2", (1, 2, 3)), ("mc3", (5,)), ("mc4", (1,))):
        put(ref, lines(*days))
    assert len(step()) == 7
    put("mc1", lines(1, 2, 4))
    put("mc2", lines(1, 2))
    put("mc3", lines(6) + lines(7))
    assert step() == [("mc1", "appended", 4.0), ("mc2", "replaced", 1.0), ("mc2", "replaced", 2.0), ("mc3", "replaced", 6.0), ("mc3", "replaced", 7.0)]
    assert step() == []
    put("mc2", "")
    (tmp_path / "steer_mc4.dat").unlink()
    assert step() == [("mc2", "replaced", None), ("mc4", "replaced", None)]
    put("mc2", lines(9))
    assert step() == [("mc2", "replaced", 9.0)]  # nothing is known of an empty file
    state = {r.ref: r for r in known.collect()}
    assert state["mc1"].n_lines == 3 and state["mc1"].size == len(lines(1, 2, 4)) and set(state) == {"mc1", "mc2", "mc3"}
    put("mc1", lines(1, 2, 4) + "60005.2500")  # not ended yet
    changes, after = steering.increment(spark, str(tmp_path), known)
    assert changes.count() == 0 and {r.ref: r.size for r in after.collect()}["mc1"] == state["mc1"].size


@pytest.mark.parametrize("more", [lines(1), "60009.250000 x 0\n", "60009.250000 1 0 \xe9\n"])
def test_bad_or_backward_lines_are_errors(spark, tmp_path, more):
    path = tmp_path / "steer_mc1.dat"
    path.write_text(lines(1, 3))
    known = staged(steering.increment(spark, str(tmp_path))[1], "state")
    path.write_bytes((lines(1, 3) + more).encode("latin-1"))
    with pytest.raises(Exception, match="steering of mc1"):
        steering.increment(spark, str(tmp_path), known)[0].collect()
