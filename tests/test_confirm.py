"""Reply matching against brute force, and stream = batch for closed messages."""

import datetime as dt
import os
import re
import uuid

from pyspark.sql import functions as F

from paths import SF_SMALL
from ledgerlens import fixture as fx
from ledgerlens.plans import (
    confirm_messages,
    confirm_outcomes,
    confirm_outcomes_by_instant,
    confirm_report,
    mark_not_found,
)
from ledgerlens.plans.confirm import instant_cells
from ledgerlens.sources import confirm_contacts
from ledgerlens.sources import testdata_view as derived_view
from ledgerlens.sources.testdata import StreamingTables, replies, sent_messages
from ledgerlens.streaming import run_to_end, start_confirm_stream

T0 = dt.datetime(2025, 1, 6, 12, 0, 0)


def _s(sec):
    return T0 + dt.timedelta(seconds=sec)


def brute_force(sent, reps, timeout):
    out = {}
    for mid, cid, ts in sent:
        cands = [(rts, rid, txt.strip()) for rid, rc, rts, txt in reps
                 if rc == cid and txt is not None and txt.strip() and ts < rts <= ts + dt.timedelta(seconds=timeout)]
        best = min(cands) if cands else None
        out[mid] = ("RESPONDIDO", best[2], best[0]) if best else ("SEM RESPOSTA", None, None)
    return out


SENT = [(1, 10, _s(0)), (2, 10, _s(100)), (3, 20, _s(0)), (4, 30, _s(0)), (5, 40, _s(250)),
        (6, 50, _s(10)), (7, 60, _s(299)), (8, 10, _s(400))]
REPLIES = [
    (100, 10, _s(-5), "antes"),        # before the send
    (101, 10, _s(0), "no envio"),      # exactly at send: not after it
    (102, 10, _s(300), " SIM "),       # exactly at send + timeout (message 1), inside for 2
    (103, 10, _s(301), "tarde"),
    (104, 20, _s(50), "   "),          # blank, ignored
    (105, 20, _s(60), "NÃO"),
    (106, 30, _s(301), "SIM"),         # just after the timeout
    (107, 40, _s(260), "b"), (108, 40, _s(260), "a"),   # same time: lower id wins
    (109, 60, _s(301), "next bucket"),
]


def test_outcomes_match_brute_force_all_bucket_sizes(spark):
    sent = spark.createDataFrame(SENT, "message_id long, contact_id long, sent_ts timestamp_ntz")
    reps = spark.createDataFrame(REPLIES, "reply_id long, contact_id long, reply_ts timestamp_ntz, reply_text string")
    want = brute_force(SENT, REPLIES, 300)
    assert want[1] == ("RESPONDIDO", "SIM", _s(300)) and want[4][0] == "SEM RESPOSTA"
    for fine in (1, 7, 64, 1000, 300_000_000):
        got = {r.message_id: (r.status, r.resposta, r.reply_ts)
               for r in confirm_outcomes(sent, reps, timeout_seconds=300, fine_buckets=fine).collect()}
        assert got == want, fine


def test_send_error_wins(spark):
    sent = spark.createDataFrame([(1, 10, _s(0), "ERRO - FALHA AO ENVIAR"), (2, 20, _s(0), None)],
                                 "message_id long, contact_id long, sent_ts timestamp_ntz, send_error string")
    reps = spark.createDataFrame([(1, 10, _s(5), "SIM"), (2, 20, _s(5), "SIM")],
                                 "reply_id long, contact_id long, reply_ts timestamp_ntz, reply_text string")
    got = {r.message_id: (r.status, r.resposta) for r in confirm_outcomes(sent, reps, timeout_seconds=60).collect()}
    assert got == {1: ("ERRO - FALHA AO ENVIAR", None), 2: ("RESPONDIDO", "SIM")}


def test_fixture_outcomes_brute_force(spark):
    sent_df = derived_view(spark, SF_SMALL, "sent_messages")
    rep_df = derived_view(spark, SF_SMALL, "replies")
    sent = [tuple(r) for r in sent_df.collect()]
    reps = [tuple(r) for r in rep_df.collect()]
    want = brute_force(sent, reps, fx.REPLY_TIMEOUT_SECONDS)
    got = {r.message_id: (r.status, r.resposta, r.reply_ts)
           for r in confirm_outcomes(sent_df, rep_df, timeout_seconds=fx.REPLY_TIMEOUT_SECONDS,
                                     fine_buckets=24).collect()}
    assert got == want
    assert len(got) == 188 and sum(v[0] == "RESPONDIDO" for v in got.values()) == 63


def _rows(df):
    return sorted(map(str, df.select("message_id", "contact_id", "sent_ts", "status", "resposta", "reply_ts").collect()))


def test_stream_over_one_file_equals_batch(spark, tmp_out):
    t = StreamingTables(spark, SF_SMALL)
    tables = run_to_end(spark, sent_messages(t), replies(t), folder=os.path.join(tmp_out, "t"),
                        checkpoint=os.path.join(tmp_out, "c"), timeout_seconds=fx.REPLY_TIMEOUT_SECONDS,
                        name=f"t_{uuid.uuid4().hex[:8]}")
    batch = confirm_outcomes(derived_view(spark, SF_SMALL, "sent_messages"), derived_view(spark, SF_SMALL, "replies"),
                             timeout_seconds=fx.REPLY_TIMEOUT_SECONDS)
    assert _rows(tables.outcomes()) == _rows(batch) and batch.count() == 188 and tables.late() == (0, 0)


def _drop(spark, folder, k, sent, reps):
    """One more input file for each side."""
    spark.createDataFrame(sent, "message_id long, contact_id long, sent_ts timestamp_ntz").coalesce(1).write.parquet(
        os.path.join(folder, "sent", f"{k}"))
    spark.createDataFrame(reps, "reply_id long, contact_id long, reply_ts timestamp_ntz, reply_text string").coalesce(
        1).write.parquet(os.path.join(folder, "rep", f"{k}"))


def test_stream_with_several_files_a_restart_and_late_rows(spark, tmp_out):
    from pyspark.sql import types as T

    hour = 3600
    sent = [(i, i % 3 if i % 10 else None, _s(i * 600)) for i in range(60)]          # ten hours
    reps = [(1000 + i, i % 3, _s(i * 500 + 7), "SIM" if i % 4 else " ") for i in range(70)]
    late_message, late_reply = (900, 1, _s(60)), (2900, 2, _s(61), "tarde")
    schema_s = T.StructType.fromDDL("message_id long, contact_id long, sent_ts timestamp_ntz")
    schema_r = T.StructType.fromDDL("reply_id long, contact_id long, reply_ts timestamp_ntz, reply_text string")
    folder = os.path.join(tmp_out, "tables")

    def run(finish):
        s = spark.readStream.schema(schema_s).option("recursiveFileLookup", True).parquet(os.path.join(tmp_out, "sent"))
        r = spark.readStream.schema(schema_r).option("recursiveFileLookup", True).parquet(os.path.join(tmp_out, "rep"))
        options = dict(folder=folder, checkpoint=os.path.join(tmp_out, "ckpt"), timeout_seconds=1800,
                       delay_seconds=900, name=f"t_{uuid.uuid4().hex[:8]}")
        if finish:
            return run_to_end(spark, s, r, **options)
        q, tables = start_confirm_stream(spark, s, r, available_now=True, **options)
        q.awaitTermination()
        return tables

    early = lambda rows: [x for x in rows if x[2] < _s(3 * hour)]
    middle = lambda rows: [x for x in rows if _s(3 * hour) <= x[2] < _s(7 * hour)]
    last = lambda rows: [x for x in rows if x[2] >= _s(7 * hour)]
    _drop(spark, tmp_out, 1, early(sent), early(reps))
    first = run(False)
    done = first.outcomes().count()
    assert 0 < done < len(early(sent))                       # open buckets wait
    _drop(spark, tmp_out, 2, [*middle(sent), late_message], [*middle(reps), late_reply])
    second = run(False)                                      # a restart from the stream's checkpoint
    assert second.late() == (1, 1)
    assert done < second.outcomes().count() < len(early(sent)) + len(middle(sent))
    events = second.input.schema
    again = second.events(["part=trigger-1"]).drop("closed_before")
    second.trigger(spark.createDataFrame(again.collect(), events), 1)
    assert second.late() == (1, 1)                           # a trigger run twice counts once
    _drop(spark, tmp_out, 3, last(sent), last(reps))
    got = run(True).outcomes()
    all_sent, all_reps = [*sent, late_message], [*reps, late_reply]
    want = brute_force([s for s in all_sent if s[1] is not None], all_reps, 1800)
    want.update({s[0]: ("SEM RESPOSTA", None, None) for s in all_sent if s[1] is None})
    rows = got.collect()
    assert len(rows) == len(all_sent) == got.select("message_id").distinct().count()
    found = {r.message_id: (r.status, r.resposta, r.reply_ts) for r in rows}
    # only answers that came late may be missing
    assert {k: v for k, v in found.items() if v != want[k]}.keys() <= {
        s[0] for s in sent if s[1] == 2 and late_reply[2] - dt.timedelta(seconds=1800) <= s[2] < late_reply[2]}


def test_stream_of_nothing(spark, tmp_out):
    _drop(spark, tmp_out, 0, [], [])
    sent, rep = (os.path.join(tmp_out, d) for d in ("sent", "rep"))
    s = spark.readStream.schema(spark.read.parquet(f"{sent}/0").schema).option("recursiveFileLookup", True).parquet(sent)
    r = spark.readStream.schema(spark.read.parquet(f"{rep}/0").schema).option("recursiveFileLookup", True).parquet(rep)
    tables = run_to_end(spark, s, r, folder=os.path.join(tmp_out, "t"), checkpoint=os.path.join(tmp_out, "c"),
                        timeout_seconds=60, name=f"t_{uuid.uuid4().hex[:8]}")
    assert tables.outcomes().count() == 0


def test_blank_means_unicode_white_space(spark):
    sent = spark.createDataFrame([(1, 10, _s(0))], "message_id long, contact_id long, sent_ts timestamp_ntz")
    reps = spark.createDataFrame([(1, 10, _s(5), "\u00a0\u2003\x1c"), (2, 10, _s(6), "\u00a0 SIM\t\u3000")],
                                 "reply_id long, contact_id long, reply_ts timestamp_ntz, reply_text string")
    r = confirm_outcomes(sent, reps, timeout_seconds=60).collect()[0]
    assert (r.resposta, r.reply_ts) == ("SIM", _s(6))


def test_matching_reads_each_side_once(spark):
    out = confirm_outcomes(derived_view(spark, SF_SMALL, "sent_messages"), derived_view(spark, SF_SMALL, "replies"),
                           timeout_seconds=fx.REPLY_TIMEOUT_SECONDS)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 2
    assert plan.count("Exchange hashpartitioning") <= 3 and plan.count("ReusedExchange") >= 1
    assert plan.count(" Window [") + plan.count("- Window ") >= 1


def test_confirm_report_has_every_contact_and_message(spark):
    contacts = confirm_contacts(derived_view(spark, SF_SMALL, "contacts"))
    prepared = confirm_messages(contacts, company="ACME", template=fx.TEMPLATE)
    sent = derived_view(spark, SF_SMALL, "sent_messages")
    outcomes = confirm_outcomes(sent, derived_view(spark, SF_SMALL, "replies"),
                                timeout_seconds=fx.REPLY_TIMEOUT_SECONDS)
    report = confirm_report(prepared, outcomes, run_ts=fx.RUN_TS, timeout_seconds=fx.REPLY_TIMEOUT_SECONDS)
    assert report.columns == ["nome_cliente", "telefone", "notas_fiscais", "status", "resposta", "data_hora"]
    invalid = prepared.filter("NOT telefone_valido").count()
    assert report.filter("status = 'ERRO - TELEFONE INVÁLIDO'").count() == invalid > 0
    bad_raw = report.filter("status = 'ERRO - TELEFONE INVÁLIDO'").select("telefone").distinct().collect()
    assert {r.telefone for r in bad_raw} == {"sem telefone"}
    silent = prepared.filter("telefone_valido").join(sent, "contact_id", "left_anti").count()
    assert report.filter("status = 'NÃO ENVIADO'").count() == silent > 0
    assert report.count() == invalid + silent + sent.count()


def test_confirm_report_stamps_a_sending_error_when_it_happened(spark):
    sent = spark.createDataFrame([(1, 10, _s(0), "ERRO - x", _s(3)), (2, 99, _s(1), None, None)],
                                 "message_id long, contact_id long, sent_ts timestamp_ntz, send_error string, "
                                 "error_ts timestamp_ntz")
    reps = spark.createDataFrame([], "reply_id long, contact_id long, reply_ts timestamp_ntz, reply_text string")
    sheet = spark.createDataFrame([(10, "Ana", "81999990000", "1")],
                                  "contact_id long, nome_cliente string, telefone string, notas_fiscais string")
    prepared = confirm_messages(sheet, company="ACME", template=fx.TEMPLATE)
    outcomes = confirm_outcomes(sent, reps, timeout_seconds=60)
    rows = confirm_report(prepared, outcomes, run_ts=T0, timeout_seconds=60).collect()
    assert {(r.nome_cliente, r.status, r.data_hora) for r in rows} == {
        ("Ana", "ERRO - x", _s(3)), (None, "SEM RESPOSTA", _s(61))}


def test_outcomes_independent_of_session_time_zone(spark):
    sent = spark.createDataFrame(SENT, "message_id long, contact_id long, sent_ts timestamp_ntz")
    reps = spark.createDataFrame(REPLIES, "reply_id long, contact_id long, reply_ts timestamp_ntz, reply_text string")
    want = brute_force(SENT, REPLIES, 300)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        got = {r.message_id: (r.status, r.resposta, r.reply_ts)
               for r in confirm_outcomes(sent, reps, timeout_seconds=300, fine_buckets=5).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == want


def test_random_hot_contact_matches_brute_force(spark):
    import random

    rnd = random.Random(7)
    sent, reps = [], []
    for i in range(400):
        contact = 1 if rnd.random() < 0.6 else rnd.choice([2, 3, None])   # one dominant contact
        sent.append((i, contact, _s(rnd.randint(0, 3000))))
    for j in range(600):
        contact = 1 if rnd.random() < 0.6 else rnd.choice([2, 3, None])
        text = rnd.choice(["SIM", "NÃO", "  ", "ok "])
        reps.append((10_000 + j, contact, _s(rnd.randint(0, 3300)), text))
    sdf = spark.createDataFrame(sent, "message_id long, contact_id long, sent_ts timestamp_ntz")
    rdf = spark.createDataFrame(reps, "reply_id long, contact_id long, reply_ts timestamp_ntz, reply_text string")
    want = brute_force([s for s in sent if s[1] is not None], [r for r in reps if r[1] is not None], 120)
    want.update({s[0]: ("SEM RESPOSTA", None, None) for s in sent if s[1] is None})
    for fine in (1, 3, 64):
        got = {r.message_id: (r.status, r.resposta, r.reply_ts)
               for r in confirm_outcomes(sdf, rdf, timeout_seconds=120, fine_buckets=fine).collect()}
        assert got == want, fine


def test_a_finite_run_with_late_replies_equals_batch(spark, tmp_out):
    from pyspark.sql import types as T

    sent = [(i, i % 3, _s(i * 600)) for i in range(60)]
    on_time = [(1000, 0, _s(36100), "SIM"), (1001, 1, _s(4 * 600 + 900), "SIM")]
    # answers that come hours later, one of them into the bucket after the last closed one
    late = [(2000 + i, i % 3, _s(i * 600 + 30), "tarde") for i in (0, 4, 20, 51, 52, 53, 54, 55, 56, 57)]
    late += [(2900, 1, _s(4 * 600 + 1), "antes")]
    folder = os.path.join(tmp_out, "tables")
    for k, rows in ((1, (sent, on_time)), (2, ([], late))):
        _drop(spark, tmp_out, k, *rows)
        s = spark.readStream.schema(T.StructType.fromDDL("message_id long, contact_id long, sent_ts timestamp_ntz")).option(
            "recursiveFileLookup", True).parquet(os.path.join(tmp_out, "sent"))
        r = spark.readStream.schema(T.StructType.fromDDL(
            "reply_id long, contact_id long, reply_ts timestamp_ntz, reply_text string")).option(
            "recursiveFileLookup", True).parquet(os.path.join(tmp_out, "rep"))
        options = dict(folder=folder, checkpoint=os.path.join(tmp_out, "ckpt"), timeout_seconds=1800, delay_seconds=900,
                       name=f"t_{uuid.uuid4().hex[:8]}")
        if k == 1:
            q, first = start_confirm_stream(spark, s, r, available_now=True, **options)
            q.awaitTermination()
            written = first.outcomes().count()
            assert 0 < written < len(sent)
        else:
            tables = run_to_end(spark, s, r, **options)
    rows = tables.outcomes().collect()
    assert len(rows) == len(sent) and tables.late()[1] > 0
    assert {x.message_id: (x.status, x.resposta, x.reply_ts) for x in rows} == brute_force(sent, on_time + late, 1800)
    tables.close_tail()  # again
    assert sorted(map(str, tables.outcomes().collect())) == sorted(map(str, rows))


def test_progress_names_open_folders_and_merges_closed_ones():
    from ledgerlens.streaming.confirm_stream import Progress

    state, read, merged_in = Progress(), {}, {}
    for epoch in range(400):
        own = (f"part=trigger-{epoch}", epoch)  # one bucket a trigger, closed three triggers later
        read[epoch] = [f for f, _ in state.open] + [own[0]]
        state, merges = state.after(epoch, epoch - 3 if epoch >= 3 else None, epoch, (1, 0), own, merge=4)
        for name, some in merges:
            assert name not in merged_in
            merged_in[name] = some
        assert len(state.closed) <= 4 * 6
    assert len(read[20]) == len(read[200]) == len(read[399]) == 4
    assert state.late_messages == 400

    def originals(folder):
        return [x for f in merged_in[folder] for x in originals(f)] if folder in merged_in else [folder]

    held = [x for f in state.folders for x in originals(f)]
    assert sorted(held) == sorted(f"part=trigger-{e}" for e in range(400))  # every folder once, none lost


def test_stream_work_does_not_grow_with_history(spark, tmp_out, monkeypatch):
    from ledgerlens.streaming import confirm_stream as cs

    sent = [(i, i % 4, _s(i * 300)) for i in range(72)]
    reps = [(1000 + i, i % 4, _s(i * 300 + 40), "SIM") for i in range(0, 72, 2)]
    sdf = spark.createDataFrame(sent, "message_id long, contact_id long, sent_ts timestamp_ntz")
    rdf = spark.createDataFrame(reps, "reply_id long, contact_id long, reply_ts timestamp_ntz, reply_text string")
    tables = cs.ConfirmTables(spark, os.path.join(tmp_out, "tables"), sdf, rdf, timeout_seconds=600, delay_seconds=300)
    read = {}
    plain, merge = cs.ConfirmTables.events, cs.Progress.after
    monkeypatch.setattr(cs.Progress, "after", lambda self, *a: merge(self, *a, merge=3))

    def counting(self, folders):
        out = plain(self, folders)
        read.setdefault(now[0], []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(cs.ConfirmTables, "events", counting)
    now = [0]
    base = F.to_timestamp_ntz(F.lit(str(T0)))
    for epoch in range(24):
        now[0] = epoch
        batch = tables.input.filter((F.col("ts") >= base + F.expr(f"INTERVAL {900 * epoch} SECONDS"))
                                    & (F.col("ts") < base + F.expr(f"INTERVAL {900 * (epoch + 1)} SECONDS")))
        tables.trigger(batch, epoch)
        if epoch == 10:
            tables.trigger(batch, epoch)  # run again after a failure
    # own folder and open folders; a merge adds its folders' files
    assert max(read[22][:2]) <= max(read[7][:2]) + 1 and max(map(max, read.values())) < 24
    monkeypatch.undo()
    gone = tables.vacuum()
    assert gone and len(tables.progress().folders) < 14
    tables.close_tail()
    rows = tables.outcomes().collect()
    assert len(rows) == len(sent)
    assert {x.message_id: (x.status, x.resposta, x.reply_ts) for x in rows} == brute_force(sent, reps, 600)


SENT_TYPE = "message_id long, contact_id long, sent_ts timestamp_ntz"
REPLY_TYPE = "reply_id long, contact_id long, reply_ts timestamp_ntz, reply_text string"


def _by_instant(spark, sent, reps, timeout):
    rows = confirm_outcomes_by_instant(spark.createDataFrame(sent, SENT_TYPE), spark.createDataFrame(reps, REPLY_TYPE),
                                       timeout_seconds=timeout).collect()
    assert len(rows) == len(sent)
    return {r.message_id: (r.status, r.resposta, r.reply_ts) for r in rows}


def test_matching_by_instant_equals_brute_force(spark):
    assert _by_instant(spark, SENT, REPLIES, 300) == brute_force(SENT, REPLIES, 300)
    odd = [(1, None, _s(0)), (2, 5, None), (3, 5, _s(0)), (4, 5, _s(0))]
    none = ("SEM RESPOSTA", None, None)
    got = _by_instant(spark, odd, [(1, None, _s(1), "x"), (2, 5, None, "x"), (3, 5, _s(1), "SIM"), (4, 5, _s(1), "x")], 300)
    assert got == {1: none, 2: none, 3: ("RESPONDIDO", "SIM", _s(1)), 4: ("RESPONDIDO", "SIM", _s(1))}
    assert _by_instant(spark, [], REPLIES, 300) == {}
    assert set(_by_instant(spark, SENT, [], 300).values()) == {none}


def test_matching_by_instant_with_most_events_in_one_minute(spark):
    import random

    for timeout, step in ((1, 1), (120, 1_000_000), (120, 7)):
        rnd = random.Random(timeout + step)

        def at():
            if rnd.random() < 0.6:                                  # one contact, one minute (or a few microseconds)
                return 1, _s(600) + dt.timedelta(microseconds=step * rnd.randrange(60))
            return rnd.choice([1, 2, 3]), _s(rnd.randrange(3000)) + dt.timedelta(microseconds=rnd.randrange(10 ** 6))

        sent = [(i, *at()) for i in range(500)]
        reps = [(10_000 + i, *at(), rnd.choice(["SIM", "NÃO", "  ", "ok "])) for i in range(700)]
        assert _by_instant(spark, sent, reps, timeout) == brute_force(sent, reps, timeout)


def test_matching_by_instant_bounds_its_windows(spark):
    for timeout in (1, 2, 300, 3600, 86_400):
        width, cells = instant_cells(timeout)
        assert width * cells >= timeout * 1_000_000 and width <= cells <= (timeout * 1_000_000) ** 0.5 + 1
    assert 2 * instant_cells(300)[1] == 34_642
    out = confirm_outcomes_by_instant(derived_view(spark, SF_SMALL, "sent_messages"),
                                      derived_view(spark, SF_SMALL, "replies"), timeout_seconds=300)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Instants are reduced before their exchange.
    assert re.search(r"Exchange hashpartitioning\(contact_id#\d+L, __us#\d+L, .*\n.*Aggregate\(key=\[contact_id#\d+L, __us#\d+L\], "
                     r"functions=\[partial_min\(__v", plan)
    assert plan.count("FileScan parquet") == 3 and "ReusedExchange" in plan


def test_messages_to_unknown_contacts_are_not_found(spark):
    sent = spark.createDataFrame([(1, 10, _s(0)), (2, 99, _s(0)), (3, None, _s(0))], SENT_TYPE)
    reps = spark.createDataFrame([(1, 10, _s(5), "SIM"), (2, 99, _s(5), "SIM")], REPLY_TYPE)
    known = spark.createDataFrame([(10,), (10,), (None,)], "contact_id long")
    lost = "ERRO - CONTATO NÃO ENCONTRADO"
    for match in (confirm_outcomes, confirm_outcomes_by_instant):
        rows = match(mark_not_found(sent, known), reps, timeout_seconds=60).collect()
        assert {r.message_id: (r.status, r.resposta) for r in rows} == {
            1: ("RESPONDIDO", "SIM"), 2: (lost, None), 3: (lost, None)}
    already = sent.withColumn("send_error", F.when(F.col("message_id") == 2, "ERRO - x"))
    assert {r.message_id: r.send_error for r in mark_not_found(already, known).collect()} == {
        1: None, 2: "ERRO - x", 3: lost}
