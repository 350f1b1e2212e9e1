import datetime as dt

from tracklens.operators import interactions as I

T0 = dt.datetime(2024, 1, 1)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def test_first_answer_wins_and_bands(spark):
    rows = [
        # learner 1: all right, a later wrong answer does not count
        (1, 0, 0, at(1), 1), (1, 0, 3, at(2), 2), (1, 1, 1, at(3), 3), (1, 2, 2, at(4), 4),
        # learner 2: one wrong, decided by the event id on equal times
        (2, 0, 1, at(1), 5), (2, 0, 0, at(1), 6), (2, 1, 1, at(2), 7), (2, 2, 2, at(2), 8),
        # learner 3: two wrong; learner 4: not finished
        (3, 0, 1, at(1), 9), (3, 1, 0, at(1), 10), (3, 2, 2, at(1), 11), (4, 0, 0, at(1), 12),
    ]
    answers = spark.createDataFrame(rows, "learner INT, item INT, pick INT, ts TIMESTAMP, event_id BIGINT")
    key = spark.createDataFrame([(0, 0), (1, 1), (2, 2)], "item INT, ans INT")
    found = {r.learner: (r.right, r.answered, r.band) for r in I.quiz_score(answers, key).collect()}
    assert found == {
        1: (3, 3, "clean sweep"),
        2: (2, 3, "solid"),
        3: (1, 3, "worth a re-read"),
        4: (1, 1, None),
    }
    sorted_all = {r.learner: r.all_sorted for r in I.sorter_score(answers, key).collect()}
    assert sorted_all == {1: True, 2: True, 3: True, 4: False}


def test_checklist_reset_then_recheck(spark):
    rows = [
        (1, "l", 0, "set", True, at(1), 1),
        (1, "l", 1, "set", True, at(2), 2),
        (1, "l", 0, "reset", None, at(3), 3),
        (1, "l", 1, "set", True, at(4), 4),
        (1, "l", 2, "set", True, at(5), 5),
        (1, "l", 2, "set", False, at(6), 6),
        (2, "l", 0, "set", True, at(3), 7),
    ]
    events = spark.createDataFrame(rows, "learner INT, list STRING, box INT, kind STRING, checked BOOLEAN, ts TIMESTAMP, event_id BIGINT")
    boxes = spark.createDataFrame([("l", i) for i in range(4)], "list STRING, box INT")
    found = {r.learner: (r.done, r.total, r.pct) for r in I.checklist(events, boxes).collect()}
    assert found == {1: (1, 4, 25.0), 2: (1, 4, 25.0)}


def test_progress_and_resume(spark):
    rows = [(3, 7, 11), (0, 7, 11), (12, 7, 11), (None, 40, 11), (None, None, 11), (1, 0, 1)]
    df = spark.createDataFrame(rows, "hash_slide INT, saved INT, slides INT")
    got = [(r.at, r.pct) for r in I.progress(df).collect()]
    assert got == [(2, 20.0), (7, 70.0), (7, 70.0), (10, 100.0), (0, 0.0), (0, 0.0)]


def test_seen(spark):
    rows = [(1, 4, at(1), 1), (1, 2, at(3), 2), (1, 4, at(2), 3)]
    (r,) = I.seen(spark.createDataFrame(rows, "learner INT, slide INT, ts TIMESTAMP, event_id BIGINT")).collect()
    assert (r.slides, r.n_seen, r.at) == ([2, 4], 2, 2)
