"""Players of a position are counted before they meet the slots, so no task gets all rows of a position."""

from matchloom.functions import fixed
from matchloom.plans import views


def test_players_are_counted_before_they_meet_the_slots(spark):
    rows = [("DC", "a"), ("DC", "a"), ("DC", "b"), ("DC", None), ("POR", None), ("OTRO", "c"), (None, "d"), ("LD", "0" * 64), ("LD", "")]
    out = views.players_per_slot(spark.createDataFrame(rows, "posicion_xi string, id_jugador string").repartition(3))
    got = out.collect()
    assert len(got) == len(fixed.SLOTS) == out.select("id_formacion", "slot").distinct().count()
    assert all(r.jugadores == {"DC": 2, "LD": 2}.get(r.posicion_xi, 0) for r in got)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join")
    assert plan.index("count(_player") > join and "jugadores" in plan[:join]
