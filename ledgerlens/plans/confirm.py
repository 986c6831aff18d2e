"""Customer confirmation job, set-based.

Messages are prepared per contact with column expressions. Replies are matched
to sent messages by a forward as-of join (first non-blank reply strictly after
the message, within the timeout) that never pairs a message with the replies of
its contact and keeps every group bounded:

* time is cut into *coarse* buckets at least one timeout wide, each split into
  ``fine_buckets`` *fine* buckets;
* messages and replies are read once each and exchanged once by (contact, fine
  bucket); one window there, in descending time, gives each message the first
  later reply of its own fine bucket, and a grouping on the same exchange gives
  each fine bucket its first reply;
* a second window over (contact, coarse bucket) runs on those one-row-per-fine-
  bucket firsts, replies also standing in the coarse bucket before theirs (at
  most 2 x ``fine_buckets`` rows per group), and gives the first reply of any
  later fine bucket;
* that is joined to the messages by (contact, fine bucket).

A reply within the timeout lies in the message's coarse bucket or the next,
so the earlier of the two candidates is the exact answer. The first window's
group holds one contact's events of one fine bucket (timeout / ``fine_buckets``
of time), so a dominant contact is spread over many tasks; messages without a
contact match nothing and are spread by their own identifier.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.constants import (
    CONFIRM_DEFAULT_TIMEOUT_SECONDS,
    CONFIRM_STATUS_ANSWERED,
    CONFIRM_STATUS_INVALID_PHONE,
    CONFIRM_STATUS_NO_ANSWER,
    CONFIRM_STATUS_NOT_FOUND,
    CONFIRM_STATUS_NOT_SENT,
)
from ledgerlens.functions import (
    confirm_message,
    confirm_notes,
    confirm_notes_text,
    confirm_phone,
    confirm_removed_count,
    confirm_sanitize,
    strip_text,
)

_EPOCH_TEXT = "1970-01-01 00:00:00"


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since 1970-01-01 without any time-zone shift for ``timestamp_ntz``."""
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        # Built from text: a Python datetime literal would pass through the session time zone.
        return F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit(_EPOCH_TEXT)), F.col(col))
    return F.unix_micros(F.col(col))


def confirm_messages(contacts: DataFrame, *, company: str, template: str) -> DataFrame:
    """Per contact (``nome_cliente``, ``telefone``, ``notas_fiscais``, ...): cleaned phone,
    note list and text, whether the phone is usable, and the sanitized message with
    the number of characters sanitizing removed. Other columns are kept."""
    notes = confirm_notes("notas_fiscais")
    phone = confirm_phone("telefone")
    raw_msg = confirm_message(F.col("nome_cliente"), notes, company=company, template=template)
    return contacts.select(
        "*",
        phone.alias("telefone_limpo"),
        phone.isNotNull().alias("telefone_valido"),
        notes.alias("notas"),
        confirm_notes_text(notes).alias("notas_texto"),
        confirm_sanitize(raw_msg).alias("mensagem"),
        confirm_removed_count(raw_msg).alias("caracteres_removidos"),
    )


def confirm_outcomes(messages: DataFrame, replies: DataFrame, *,
                     timeout_seconds: int = CONFIRM_DEFAULT_TIMEOUT_SECONDS,
                     fine_buckets: int = 64) -> DataFrame:
    """One row per sent message with ``status``, ``resposta`` and ``reply_ts``.

    ``messages``: ``message_id``, ``contact_id``, ``sent_ts`` and optionally
    ``send_error`` (a sending failure, which wins over any reply); other columns
    are carried. ``replies``: ``reply_id``, ``contact_id``, ``reply_ts``,
    ``reply_text``. A message is answered by the first non-blank reply strictly
    after it and at most ``timeout_seconds`` later (ties by ``reply_id``); a
    message or reply without a contact matches nothing.
    """
    if timeout_seconds <= 0 or fine_buckets < 1:
        raise ValueError("timeout and fine_buckets must be positive")
    fine_us = math.ceil(timeout_seconds * 1_000_000 / fine_buckets)   # coarse = fine_us * fine_buckets >= timeout

    def keyed(df: DataFrame, ts: str, spread: Column) -> list[Column]:
        f = F.floor(epoch_micros(df, ts) / fine_us)
        return ["contact_id", f.alias("__f"), F.floor(f / fine_buckets).alias("__c"), spread.alias("__s")]

    text = strip_text("reply_text")
    rep = replies.filter((text != "") & F.col("contact_id").isNotNull())
    reply = F.struct(F.col("reply_ts").alias("ts"), F.col("reply_id").alias("id"), text.alias("text"))
    r_type = rep.select(reply.alias("r")).schema["r"].dataType
    msg_type = T.StructType(list(messages.schema.fields))

    # Both readers of `events` need all of its columns, so the exchange below is made once.
    # __s spreads messages without a contact, which would else be one group per fine bucket.
    lone = F.when(F.col("contact_id").isNull(), F.xxhash64("message_id")).otherwise(F.lit(0))
    events = messages.select(
        *keyed(messages, "sent_ts", lone), F.struct(*[F.col(f"`{c}`") for c in messages.columns]).alias("__msg"),
        F.lit(None).cast(r_type).alias("__r")).unionByName(rep.select(
            *keyed(rep, "reply_ts", F.lit(0).cast("bigint")), F.lit(None).cast(msg_type).alias("__msg"),
            reply.alias("__r"))).repartition("contact_id", "__f", "__s")
    is_msg = F.col("__msg").isNotNull()

    # (1) Fine buckets. At equal times the message sorts first, so its running frame
    # holds only strictly later replies.
    at = F.coalesce(F.col("__msg.sent_ts"), F.col("__r.ts"))
    fine = Window.partitionBy("contact_id", "__c", "__f", "__s").orderBy(at.desc(), is_msg.desc())
    msgs = events.withColumn("__same", F.min("__r").over(
        fine.rowsBetween(Window.unboundedPreceding, Window.currentRow))).filter(is_msg).drop("__r", "__c")
    firsts = events.groupBy("contact_id", "__f", "__s", "__c").agg(
        F.min("__r").alias("__v"), F.max(is_msg).alias("__asked"))

    # (2) Coarse buckets: descending by fine bucket, the rows before one are the later fine buckets.
    here = F.struct(F.col("__c"), F.lit(False).alias("next"))
    before = F.struct((F.col("__c") - 1).alias("__c"), F.lit(True).alias("next"))
    both = firsts.withColumn("__p", F.explode(F.when(F.col("__v").isNull(), F.array(here)).otherwise(
        F.array(here, before)))).select("contact_id", "__f", "__s", "__v", "__asked", "__p.*")
    coarse = Window.partitionBy("contact_id", "__c").orderBy(F.col("__f").desc())
    later = both.withColumn("__later", F.min("__v").over(coarse.rowsBetween(Window.unboundedPreceding, -1))).filter(
        ~F.col("next") & F.col("__asked") & F.col("__later").isNotNull()).select(
        *[F.col(c).alias(f"{c}_later") for c in ("contact_id", "__f", "__s")], "__later")

    # Null-safe: plain equality would push a filter below one of the two readers of `events`.
    same_bucket = [F.col(c).eqNullSafe(F.col(f"{c}_later")) for c in ("contact_id", "__f", "__s")]
    out = msgs.join(later, same_bucket, "left")
    best = F.coalesce(F.col("__same"), F.col("__later"))
    limit = F.col("__msg.sent_ts") + F.expr(f"INTERVAL {int(timeout_seconds)} SECONDS")
    return out.select(*_outcome(messages.columns, best, best.isNotNull() & (best["ts"] <= limit)))


def _outcome(columns: list[str], best: Column, answered: Column) -> list[Column]:
    """The columns of ``__msg`` with its status, answer and time; a sending error wins."""
    status = F.when(answered, F.lit(CONFIRM_STATUS_ANSWERED)).otherwise(F.lit(CONFIRM_STATUS_NO_ANSWER))
    if "send_error" in columns:
        status = F.coalesce(F.col("__msg.send_error"), status)
        answered = answered & F.col("__msg.send_error").isNull()
    return [*[F.col(f"__msg.`{c}`").alias(c) for c in columns], status.alias("status"),
            F.when(answered, best["text"]).alias("resposta"), F.when(answered, best["ts"]).alias("reply_ts")]


def instant_cells(timeout_seconds: int) -> tuple[int, int]:
    """(microseconds of a cell, cells of a coarse bucket): both the square root of the timeout, so
    a window over the instants of a cell or the cells of two buckets is bounded by the timeout alone."""
    timeout_us = timeout_seconds * 1_000_000
    cells = math.isqrt(timeout_us - 1) + 1
    return -(-timeout_us // cells), cells


def confirm_outcomes_by_instant(messages: DataFrame, replies: DataFrame, *,
                                timeout_seconds: int = CONFIRM_DEFAULT_TIMEOUT_SECONDS) -> DataFrame:
    """:func:`confirm_outcomes` where one contact may hold any share of the events of any time.

    Events are reduced to one row per contact and instant (before the shuffle too), and the
    same two steps run on these, in cells of ``instant_cells``: no window group has more than
    2 x sqrt(timeout in microseconds) rows (34,642 at 300 s), however many events share a contact,
    a minute or an instant. The answers are joined back to the messages by (contact, instant), one row on
    their side, so that AQE can split the messages of a hot instant. It costs
    a second, narrow read of the messages and three more shuffles; results are the same.
    """
    if timeout_seconds <= 0:
        raise ValueError("timeout must be positive")
    cell_us, cells = instant_cells(timeout_seconds)
    text = strip_text("reply_text")
    rep = replies.filter((text != "") & F.col("contact_id").isNotNull())
    reply = F.struct(epoch_micros(rep, "reply_ts").alias("us"), F.col("reply_id").alias("id"), text.alias("text"),
                     F.col("reply_ts").alias("ts"))
    r_type = rep.select(reply.alias("r")).schema["r"].dataType

    asked = messages.filter(F.col("contact_id").isNotNull()).select(
        "contact_id", epoch_micros(messages, "sent_ts").alias("__us"), F.lit(None).cast(r_type).alias("__v"),
        F.lit(True).alias("__asked"))
    said = rep.select("contact_id", epoch_micros(rep, "reply_ts").alias("__us"), reply.alias("__v"),
                      F.lit(False).alias("__asked"))
    cell = F.floor(F.col("__us") / cell_us)
    instants = asked.unionByName(said).groupBy("contact_id", "__us").agg(
        F.min("__v").alias("__v"), F.max("__asked").alias("__asked")).select(
            "*", cell.alias("__f"), F.floor(cell / cells).alias("__c")).repartition("contact_id", "__f")

    # Both readers of `instants` need all of its columns, so that exchange is made once.
    fine = Window.partitionBy("contact_id", "__c", "__f").orderBy(F.col("__us").desc())
    here = instants.withColumn("__same", F.min("__v").over(
        fine.rowsBetween(Window.unboundedPreceding, -1))).filter("__asked").select(
            "contact_id", "__f", "__us", "__same")
    firsts = instants.groupBy("contact_id", "__f", "__c").agg(
        F.min("__v").alias("__v"), F.max(F.when(F.col("__asked"), F.col("__us"))).alias("__last"))
    own = F.struct(F.col("__c"), F.lit(False).alias("next"))
    before = F.struct((F.col("__c") - 1).alias("__c"), F.lit(True).alias("next"))
    both = firsts.withColumn("__p", F.explode(F.when(F.col("__v").isNull(), F.array(own)).otherwise(
        F.array(own, before)))).select("contact_id", "__f", "__v", "__last", "__p.*")
    coarse = Window.partitionBy("contact_id", "__c").orderBy(F.col("__f").desc())
    later = both.withColumn("__later", F.min("__v").over(coarse.rowsBetween(Window.unboundedPreceding, -1))).filter(
        ~F.col("next") & F.col("__last").isNotNull() & F.col("__later").isNotNull()).select(
            F.col("contact_id").alias("__contact_later"), F.col("__f").alias("__f_later"), "__later")

    # Null-safe: plain equality would push a filter below one of the two readers of `instants`.
    answers = here.join(later, F.col("contact_id").eqNullSafe(F.col("__contact_later"))
                        & F.col("__f").eqNullSafe(F.col("__f_later")), "left").select(
        F.col("contact_id").alias("__contact"), "__us", F.coalesce("__same", "__later").alias("__best")).filter(
            F.col("__best.us") - F.col("__us") <= timeout_seconds * 1_000_000)
    sent = messages.select(F.struct(*[F.col(f"`{c}`") for c in messages.columns]).alias("__msg"),
                           F.col("contact_id").alias("__to"), epoch_micros(messages, "sent_ts").alias("__at"))
    out = sent.join(answers, (F.col("__to") == F.col("__contact")) & (F.col("__at") == F.col("__us")), "left")
    return out.select(*_outcome(messages.columns, F.col("__best"), F.col("__best").isNotNull()))


def mark_not_found(messages: DataFrame, directory: DataFrame, *, key: str = "contact_id") -> DataFrame:
    """``messages`` with ``send_error``: ``ERRO - CONTATO NÃO ENCONTRADO`` where the contact (or none)
    is not in ``directory``, else the error they came with (NULL if they have no such column)."""
    known = directory.select(F.col(key).alias("__known")).filter(F.col("__known").isNotNull()).distinct()
    had = F.col("send_error") if "send_error" in messages.columns else F.lit(None).cast("string")
    return messages.join(known, F.col(key) == F.col("__known"), "left").withColumn(
        "send_error", F.coalesce(had, F.when(F.col("__known").isNull(), F.lit(CONFIRM_STATUS_NOT_FOUND)))).drop("__known")


def confirm_report(prepared: DataFrame, outcomes: DataFrame, *, run_ts: _dt.datetime,
                   timeout_seconds: int = CONFIRM_DEFAULT_TIMEOUT_SECONDS,
                   contact_key: str = "contact_id") -> DataFrame:
    """The outcome table (``nome_cliente``, ``telefone``, ``notas_fiscais``, ``status``,
    ``resposta``, ``data_hora``): every contact of the sheet and every message is in it.

    * A contact without a usable phone: ``ERRO - TELEFONE INVÁLIDO``, phone and notes as given.
    * A message: its outcome with the contact's cleaned phone and notes (NULL if the sheet has
      no such contact with a usable phone), at the reply time or the end of the wait; a sending
      error at ``error_ts`` where the outcomes have that column, else at the time of sending.
    * A contact with a usable phone and no message: ``NÃO ENVIADO``.
    """
    ts_type = outcomes.schema["sent_ts"].dataType
    run = (F.to_timestamp_ntz(F.lit(run_ts.isoformat(sep=" "))) if isinstance(ts_type, T.TimestampNTZType)
           else F.lit(run_ts).cast(ts_type))
    nothing = F.lit(None).cast("string").alias("resposta")
    invalid = prepared.filter(~F.col("telefone_valido")).select(
        "nome_cliente", "telefone", "notas_fiscais",
        F.lit(CONFIRM_STATUS_INVALID_PHONE).alias("status"), nothing, run.alias("data_hora"))
    valid = prepared.filter(F.col("telefone_valido")).select(
        contact_key, "nome_cliente", F.col("telefone_limpo").alias("telefone"),
        F.col("notas_texto").alias("notas_fiscais"))
    at = F.coalesce(F.col("reply_ts"), F.col("sent_ts") + F.expr(f"INTERVAL {int(timeout_seconds)} SECONDS"))
    if "send_error" in outcomes.columns:
        failed = F.col("error_ts") if "error_ts" in outcomes.columns else F.col("sent_ts")
        at = F.when(F.col("send_error").isNotNull(), F.coalesce(failed, F.col("sent_ts"))).otherwise(at)
    messaged = outcomes.join(valid, contact_key, "left").select(
        "nome_cliente", "telefone", "notas_fiscais", "status", "resposta", at.alias("data_hora"))
    written_to = outcomes.select(contact_key).distinct()
    silent = valid.join(written_to, contact_key, "left_anti").select(
        "nome_cliente", "telefone", "notas_fiscais", F.lit(CONFIRM_STATUS_NOT_SENT).alias("status"), nothing,
        run.alias("data_hora"))
    return invalid.unionByName(messaged).unionByName(silent)
