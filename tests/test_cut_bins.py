"""Cells from bins that carry their tilt are those from bins joined with the cuts."""

from polarscan.operators import raster
from polarscan.plans import decode as d
from polarscan.queries import synth


def test_radials_are_joined_and_not_gates(spark, sf_dir):
    dec = d.decode(synth.volumes(spark, sf_dir), ["reflectivity", "velocity"])
    for cells in (raster.cells_2d, raster.cells_3d):
        got, wanted = cells(dec.cut_bins()), cells(dec.bins(), dec.cuts())
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect())) and got.count()
        plan = got._jdf.queryExecution().sparkPlan().toString()  # from the result down to the tables
        assert "Join" not in plan[: plan.index("MapInArrow")] and "Join" in plan
