"""Counts measured on the readings view at sf0.001 (FIXTURES.md §2), as an independent check."""

from fixture_rows import SF_SMALL
from smogmesh.operators import anomalies as an
from smogmesh.operators import clean as cl
from smogmesh.operators import graph as gr
from smogmesh.sources.readings import readings_view
from smogmesh.streaming import with_severity


def test_view_facts(spark):
    raw = readings_view(spark, SF_SMALL)
    clean = cl.clean(raw)
    assert (raw.count(), cl.dedupe(raw).count(), clean.count()) == (1010, 1000, 860)
    fixed = {r[0]: r[1] for r in an.count_by(an.label_fixed(raw), "anomalie_type").collect()}
    assert fixed == {"PM2.5_CRITIQUE": 128, "PM10_CRITIQUE": 3, "O3_CRITIQUE": 11, "TEMP_IMPOSSIBLE": 19, "NORMAL": 849}
    assert an.zscore(raw).count() == 21
    f = an.quartile_fences(raw).collect()[0]
    assert (f.q1, f.q3) == (4.0, 50.0)
    assert an.iqr(raw).count() == 33
    ctx = {r[0]: r[1] for r in an.count_by(an.context_anomalies(raw), "anomalie_contexte").collect()}
    assert ctx == {"POLLUTION_NULLE_POINTE": 11, "POLLUTION_ELEVEE_NUIT": 25, "TEMP_EXTREME": 20}
    sev = {r[0]: r[1] for r in with_severity(clean).groupBy("severity").count().collect()}
    assert sev == {"DANGER": 287, "ELEVEE": 282, "NORMALE": 291}
    v, e = gr.vertices(clean), gr.edges(clean)
    assert (v.count(), e.count()) == (15, 5)
    assert gr.component_count(gr.components(v, e)).first().n_components == 10
