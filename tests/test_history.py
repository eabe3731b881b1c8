from conftest import rows

from kohortflow.plans.history import family_history


def test_family_history_rules(spark):
    events = spark.createDataFrame(
        [("p", 2000, "divorce", 40, 1), ("p", 2000, "death", 40, 2), ("q", 2001, "child_moving_out", 17, 3),
         ("q", 2002, "child_moving_out", 18, 4), ("r", 2000, "move", 30, 5)],
        "person_id string, year int, event_type string, age int, event_id int",
    )
    assert rows(family_history(events)) == [("p", 2000, "F2"), ("q", 2002, "F4")]
