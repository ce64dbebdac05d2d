"""Feed frame decoding with planted damage (FIXTURES.md section 1)."""

import json


from trackside.operators.decode import decode_frames, frames_to_envelopes
from trackside.operators.dedup import dedup_object_key
from trackside.operators.flatten import complete_rows, flatten
from trackside.sinks.lake import lake_rows


def msg(msg_type="0003", **body):
    base = {"event_type": "ARRIVAL", "toc_id": "88", "variation_status": "ON TIME",
            "train_id": "T1", "actual_timestamp": "1704067207179"}
    base.update(body)
    base = {k: v for k, v in base.items() if v is not _ABSENT}
    return {"header": {"msg_type": msg_type, "msg_queue_timestamp": "1"}, "body": base}


_ABSENT = object()


def frames_df(spark, frames):
    return spark.createDataFrame([(i, f) for i, f in enumerate(frames)], "fid long, value string")


def statuses(spark, frames, compat=False):
    d = decode_frames(frames_df(spark, frames), compat=compat, keep=["fid"])
    return [(r.fid, r.pos, r.status) for r in d.orderBy("fid", "pos").collect()]


def test_planted_frames(spark):
    frames = [
        "[]",                                                   # empty: no rows
        json.dumps([msg(), msg(train_id="T2")]),                # two messages
        "[" + json.dumps(msg()) + ",5," + json.dumps(msg()) + "]",  # bad element between
        "not json",                                             # bad frame
        json.dumps(msg()),                                      # object, not array
        "[null, " + json.dumps(msg()) + "]",                    # null element
        json.dumps([msg("0001")]),                              # other type
        json.dumps([{"body": msg()["body"]}]),                  # missing header
        json.dumps([{"header": {"msg_type": "0003"}}]),         # missing body
    ]
    got = statuses(spark, frames)
    assert got == [
        (1, 0, "ok"), (1, 1, "ok"),
        (2, 0, "ok"), (2, 1, "bad_element"), (2, 2, "ok"),
        (3, None, "bad_frame"),
        (4, None, "bad_frame"),
        (5, 0, "bad_element"), (5, 1, "ok"),
        (6, 0, "skipped"),
        (7, 0, "skipped"),
        (8, 0, "bad_time"),
    ]


def test_actual_time_cases(spark):
    frames = [json.dumps([msg(actual_timestamp=_ABSENT), msg(actual_timestamp=None),
                          msg(actual_timestamp=""), msg(actual_timestamp="abc"),
                          msg(actual_timestamp="1704067207179")])]
    assert [s for *_, s in statuses(spark, frames)] == [
        "bad_time", "bad_time", "bad_time", "bad_time", "ok"]
    # compat: an absent time reads as 0 (1970), as the original consumer did
    assert [s for *_, s in statuses(spark, frames, compat=True)][0] == "ok"


def test_flags_null_toc_and_flatten(spark):
    m = msg(toc_id=None, train_terminated=True, route="1")
    good = msg(offroute_ind=False, planned_timestamp="1704067147179")
    env = frames_to_envelopes(frames_df(spark, [json.dumps([m, good])]),
                              processed_at="P")
    flat = flatten(env).orderBy("toc_id").collect()
    assert flat[0].toc_id is None and flat[0].train_terminated == "true"
    assert flat[1].offroute_ind == "false" and flat[1].processed_at == "P"
    assert str(flat[1].actual_timestamp) == "2024-01-01 00:00:07.179000"
    assert flat[1].uk_datetime == "2024-01-01T00:00:07.179000+00:00"
    assert complete_rows(flatten(env)).count() == 1


def test_same_operator_same_second_last_writer_wins(spark):
    a = msg(train_id="FIRST", actual_timestamp="1704067207100")
    b = msg(train_id="SECOND", actual_timestamp="1704067207900")
    c = msg(train_id="OTHER", toc_id="20", actual_timestamp="1704067207500")
    env = frames_to_envelopes(frames_df(spark, [json.dumps([a, b, c])]), processed_at="P",
                              keep=["fid"])
    rows = lake_rows(env, extra=["fid", "pos"])
    kept = dedup_object_key(rows, ["fid", "pos"]).orderBy("object_name").collect()
    assert [(r.object_name, r.raw_data["train_id"]) for r in kept] == [
        ("20240101-000007-20.json", "OTHER"), ("20240101-000007-88.json", "SECOND")]


def test_decoder_plan_is_narrow_and_native(spark):
    env = frames_to_envelopes(frames_df(spark, ["[]"]), processed_at="P")
    plan = env._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "PythonUDF" not in plan and "EvalPython" not in plan


def test_envelope_matches_contract(spark):
    from trackside.schema import ENVELOPE_SCHEMA
    env = frames_to_envelopes(frames_df(spark, [json.dumps([msg()])]), processed_at="P")
    got = env.select(*ENVELOPE_SCHEMA.fieldNames()).schema
    assert [(f.name, f.dataType) for f in got] == \
        [(f.name, f.dataType) for f in ENVELOPE_SCHEMA]
