import builders as b

from bazaar.streaming import events as streaming


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_repeats_and_bad_lines_and_restart(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    first = b.event("E1", "o1", "CREATED", "2026-06-01T00:00:00Z", "c")
    write(source, "a.ndjson", [first, first, '{"event_id": "E', "", b.event(None, "o1", "PACKED", "2026-06-01T01:00:00Z")])
    lines = streaming.stream_lines(spark, str(source))
    bad = str(tmp_path / "bad")
    streaming.land_events(lines, out, state, bad)
    # A later file repeats the first event and brings a late one; the stream goes on where it stopped.
    write(source, "b.ndjson", [first, b.event("E2", "o1", "SHIPPED", "2026-02-01T00:00:00Z"), b.event(None, "o2", "PACKED", "2026-06-01T01:00:00Z")])
    streaming.land_events(lines, out, state, bad)
    found = sorted((str(r.event_id), r.order_id, r.new_status) for r in streaming.landed_events(spark, out).collect())
    assert found == [("E1", "o1", "CREATED"), ("E2", "o1", "SHIPPED"), ("None", "o1", "PACKED"), ("None", "o2", "PACKED")]
    assert [r.raw for r in spark.read.parquet(bad).collect()] == ['{"event_id": "E', ]


def test_latest_status_ignores_arrival_order(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    write(source, "a.ndjson", [b.event("E2", "o1", "SHIPPED", "2026-06-02T00:00:00Z"), b.event("E3", "o2", "CREATED", "2026-06-01T00:00:00Z", "c")])
    lines = streaming.stream_lines(spark, str(source))
    streaming.keep_latest_status(lines, out, state)
    write(source, "b.ndjson", [b.event("E1", "o1", "CREATED", "2026-06-01T00:00:00Z", "c"), b.event("E4", "o2", None, "2026-06-05T00:00:00Z", "d")])
    streaming.keep_latest_status(lines, out, state)
    found = {r.order_id: (r.op, r.new_status) for r in streaming.latest_status(spark, out).collect()}
    assert found == {"o1": ("u", "SHIPPED"), "o2": ("d", None)}
    streaming.compact_changes(spark, out)
    assert {r.order_id: (r.op, r.new_status) for r in streaming.latest_status(spark, out).collect()} == found
    assert not (tmp_path / "out/log").exists() or not list((tmp_path / "out/log").glob("batch=*"))
    write(source, "c.ndjson", [b.event("E5", "o1", "DELIVERED", "2026-06-07T00:00:00Z")])
    streaming.keep_latest_status(lines, out, state)
    found = {r.order_id: (r.op, r.new_status) for r in streaming.latest_status(spark, out).collect()}
    assert found == {"o1": ("u", "DELIVERED"), "o2": ("d", None)}


def test_a_folded_batch_may_come_back(spark, tmp_path):
    source, out, state, bad = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "bad")
    lines = streaming.stream_lines(spark, str(source) if source.mkdir() is None else "")
    status = lambda: {r.order_id: (r.op, r.new_status) for r in streaming.latest_status(spark, out).collect()}
    write(source, "a.ndjson", [b.event(f"E{i}", f"o{i}", "CREATED", "2026-06-01T00:00:00Z", "c") for i in range(4)] + ["{broken"])
    streaming.keep_latest_status(lines, out, state, bad)
    second = [b.event("E9", "o1", "SHIPPED", "2026-06-02T00:00:00Z"), b.event("E8", "o3", None, "2026-01-05T00:00:00Z", "d"), b.event("E7", "o5", None, "2026-01-05T00:00:00Z", "d")]
    write(source, "b.ndjson", second)
    streaming.keep_latest_status(lines, out, state, bad)
    want = {"o0": ("c", "CREATED"), "o1": ("u", "SHIPPED"), "o2": ("c", "CREATED"), "o3": ("c", "CREATED"), "o5": ("d", None)}
    assert status() == want and [r.raw for r in spark.read.parquet(bad).collect()] == ["{broken"]
    streaming.compact_changes(spark, out)
    assert status() == want
    # The newest batch is written once more, as after a stop before its commit; then all is folded again.
    streaming._status_sink(out, bad)(spark.createDataFrame([(x,) for x in second], "value string"), 1)
    assert status() == want
    streaming.compact_changes(spark, out)
    assert status() == want and len(list((tmp_path / "out/snapshot").glob("gen=*"))) == 1
    # A fold that stopped before it was whole is not read.
    (tmp_path / "out/snapshot/gen=9").mkdir()
    assert status() == want
    streaming.compact_changes(spark, out, "30 days")
    assert status() == {k: v for k, v in want.items() if k != "o5"}


def test_many_small_batches_stay_few_folders(spark, tmp_path, monkeypatch):
    source, out, state, bad = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "bad")
    source.mkdir()
    want, sent = set(), []
    day = tmp_path / "out/event_day=2026-06-01"
    for n in range(14):
        rows = [(f"E{n}", "2026-06-01"), (f"F{n}", f"2026-06-{n % 3 + 2:02}"), (f"E{n // 2}", "2026-06-01")]
        want |= {(i, d) for i, d in rows}
        sent.append([b.event(i, "o1", "PACKED", f"{d}T00:00:00Z") for i, d in rows])
        write(source, f"{n:02}.ndjson", sent[-1])
        streaming.land_events(streaming.stream_lines(spark, str(source)), out, state, bad)
        if n % 5 == 4:
            assert "2026-06-01" in streaming.compact_landed(spark, out, most=3)
        assert len(list(day.glob("batch=*"))) <= 8
    found = lambda: sorted((r.event_id, str(r.event_ts)[:10]) for r in streaming.landed_events(spark, out).collect())
    assert found() == sorted(want)
    # A batch that was merged comes back; a merge that stops after its note is ended by the next start.
    replay = spark.createDataFrame([(x,) for x in sent[2]], "value string")
    streaming._landing(out, bad)(replay, 2)
    assert found() == sorted(want)
    monkeypatch.setattr(streaming, "move", lambda *a: 1 / 0)
    try:
        streaming.compact_landed(spark, out, most=1)
        raise AssertionError
    except ZeroDivisionError:
        monkeypatch.undo()
    assert streaming.compact_landed(spark, out, most=99) == [] and found() == sorted(want)
    assert all(len(list((tmp_path / "out").glob(f"event_day=2026-06-0{d}/batch=*"))) == 1 for d in (1, 2, 3, 4))
