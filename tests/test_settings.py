import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from tickloom.operators import rejects
from tickloom.sources import settings

DOCUMENT = {
    "types": {"maser": {"states": 3, "m": 100, "m_sigma": 50, "sigma0": 5, "gap_limit": 40}, "plain": {"states": 1, "sigma0": 2}},
    "clocks": {"u1": [{"type": "maser", "location": 1}, {"effective_mjd": 60941.25, "m": 80}, {"effective_mjd": 60941.25, "m": 90, "disabled": True}, {"effective_mjd": 60941.5, "disabled": False}], "u2": [{"type": "plain"}]},
    "rms_limit": {"default": 50, "references": {"mc1": 60}, "pairs": {"mc1.u1": 80}},
}


def test_dated_settings(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps(DOCUMENT))
    document = settings.read(spark, str(tmp_path / "s.json"))
    got = {(r.clock, r["from"]): r for r in settings.intervals(document).collect()}
    assert set(got) == {("u1", None), ("u1", 8775540), ("u1", 8775576), ("u2", None)}
    assert (got["u1", None].m, got["u1", None].to, got["u1", 8775540].m, got["u1", 8775576].location) == (100.0, 8775540, 90.0, 1)
    off = settings.disabled_spans(document).collect()
    assert [(r.clock, r.start, r.end, r.open_ended) for r in off] == [("u1", 8775540, 8775576, False)]
    by_pair, by_ref, default = settings.rms_limits(document)
    assert by_pair.first().limit == 80 and by_ref.first().limit == 60 and default.first().limit == 50
    (tmp_path / "s.json").write_text(json.dumps(DOCUMENT | {"clocks": {"u1": [{"type": "none"}]}}))
    with pytest.raises(PySparkException, match="no type none"):
        settings.entries(settings.read(spark, str(tmp_path / "s.json"))).collect()
    (tmp_path / "s.json").write_text("{")
    with pytest.raises((PySparkException, Py4JJavaError)):
        settings.intervals(settings.read(spark, str(tmp_path / "s.json"))).collect()


def test_disabled_spans_are_taken_into_reject_stretches(spark):
    rows = [(100 + 2 * k, "u1", ["mc1"]) for k in range(30)] + [(500, f"u{k}", ["mc2", "mc1"]) for k in range(1, 6)]
    data = spark.createDataFrame(rows, "epoch long, clock string, refs array<string>")
    off = spark.createDataFrame([("u1", 165, 200, False), ("u9", 1, 2, True)], "clock string, start long, end long, open_ended boolean")
    got = rejects.reject_stretches(data, off, 20, 0.3, 4).collect()
    assert [(r.clock, r.start, r.end, r.rejections, r.rejected_epochs, r.replaced) for r in got] == [("u1", 100, 200, 30, 30, 1)]
    shared = rejects.shared_stretches(data, 20, 4).collect()
    assert [(r.start, r.end, r.most_clocks, r.reference, r.through_reference, r.rejections) for r in shared] == [(500, 501, 5, "mc1", 5, 5)]
