"""Conversation structure repair: secondary-sorted streaming with a small dynamic programme.

A conversation's role initials have to read ``(s?(ua)+)?``. Rows are kept,
given another role, deleted, or turns are inserted, at the lowest cost; of
equal costs the edits whose initials (D, I, K, R) are ASCII-least win.

Rows are repartitioned by conversation and sorted in the task, last turn
first. ``mapInPandas`` walks them and carries the cost-to-go of the four
states of the pattern from one Arrow batch to the next; each row gets one byte,
the least best edit for each state. A second sort turns the rows round, and a
second walk follows the bytes from the start. The bytes travel with their
rows through Spark's own sort, which spills: a conversation of any length takes
a few numbers of memory, and a lost executor only repeats its task. That is one
shuffle for a conversation's texts; the sorts are local.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import bounded_batches

#: Edits in ASCII order, and what they cost; a truncated row that stays adds ``TRUNCATED``.
EDITS = "DIKR"
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: States of the pattern: nothing yet, after s, after u, after a. What may follow, and where a user or assistant turn leads.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
NEXT_ROLE = ("user", "user", "assistant", "user")
#: Cost of ending in a state: turns that have to be inserted.
AT_END = (0, 2 * INSERT, INSERT, 0)
_SPACES = "".join(map(chr, (0x20, *range(0x09, 0x0E))))


def _kept(state: int, initial: str) -> int | None:
    """The state that a row of this initial leads to, if it may stand there as it is."""
    if initial == "s":
        return AFTER_S if state == START else None
    return NEXT[state] if initial == ("a" if state == AFTER_U else "u") else None


def step(after: tuple[int, ...], initial: str, fault: str | None) -> tuple[tuple[int, ...], int]:
    """Costs-to-go before a row from those behind it, and the least best edit of every state, two bits each."""
    options = []
    for state in range(4):
        paths = {"D": DELETE + after[state]}
        if fault not in ("blank", "duplicate"):
            more = TRUNCATED if fault == "truncated" else 0
            if (kept := _kept(state, initial)) is not None:
                paths["K"] = more + after[kept]
            paths["R"] = REROLE + more + after[NEXT[state]]
        options.append(paths)
    before = [min(paths.values()) for paths in options]
    for _ in range(3):  # insertions lead to another state in front of the same row, two at most are worth while
        before = [min(before[q], INSERT + before[NEXT[q]]) for q in range(4)]
    code = 0
    for state in range(4):
        options[state]["I"] = INSERT + before[NEXT[state]]
        best = min(e for e, cost in options[state].items() if cost == before[state])
        code |= EDITS.index(best) << 2 * state
    return tuple(before), code


def _codes(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds ``code`` to rows that come conversation by conversation, last row first."""
    now, costs, known = None, AT_END, {}
    for frame in frames:
        codes = []
        for conv, initial, fault in zip(frame["conv"], frame["initial"], frame["fault"], strict=True):
            if now is None or conv != now:
                now, costs = conv, AT_END
            made = known.get((costs, initial, fault))
            if made is None:
                before, code = step(costs, initial, fault)
                # Only differences decide, so few vectors of costs ever occur.
                low = min(before)
                made = known[costs, initial, fault] = tuple(c - low for c in before), code
            costs, code = made
            codes.append(code)
        frame["code"] = codes
        yield frame


def _edits(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Follows the codes of rows that come conversation by conversation, first row first."""
    columns = ["conv", "at", "edit", "cost", "turn", "was", "role", "text", "fault"]
    now, state, at = None, START, 0
    out: list[tuple] = []

    def inserted() -> None:
        nonlocal state, at
        out.append((now, at, "I", INSERT, None, None, NEXT_ROLE[state], "", None))
        state, at = NEXT[state], at + 1

    def ended() -> None:
        while now is not None and state in (AFTER_S, AFTER_U):
            inserted()

    for frame in frames:
        for conv, turn, role, text, initial, fault, code in frame[["conv", "turn", "role", "text", "initial", "fault", "code"]].itertuples(index=False, name=None):
            if now is None or conv != now:
                ended()
                now, state, at = conv, START, 0
            while (edit := EDITS[code >> 2 * state & 3]) == "I":
                inserted()
            more = TRUNCATED if fault == "truncated" else 0
            if edit == "D":
                out.append((conv, at, "D", DELETE, turn, role, None, None, fault))
            elif edit == "K":
                out.append((conv, at, "K", more, turn, role, role, text, fault))
                state = _kept(state, initial)
            else:
                out.append((conv, at, "R", REROLE + more, turn, role, NEXT_ROLE[state], text, fault))
                state = NEXT[state]
            at += 1
        yield pd.DataFrame(out, columns=columns)
        out = []
    ended()
    yield pd.DataFrame(out, columns=columns)


def _id_text(col: str) -> Column:
    """An id as text that tells null apart: Python sees ids beside nulls exactly."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit(""))


def _id_back(text: str, kind) -> Column:
    return F.when(F.col(text) != "", F.substring(F.col(text), 2, 2**31 - 1)).cast(kind)


def repair(convs: DataFrame) -> DataFrame:
    """The edits that repair every conversation of ``convs(conv_id, turn, role, text)``: one row for each, in order.

    ``conv_id, at, edit, cost, turn, was, role, text, fault``: ``edit`` is one
    of K, R, D, I; ``was`` and ``turn`` are the row's own (null for an inserted
    turn), ``role`` and ``text`` the repaired ones (null for a deleted row), so
    the repaired conversation is the rows that have a role, by ``at``. ``fault``
    is the row's first one: ``blank`` (only white space), ``duplicate`` (role
    and text stood earlier), ``truncated`` (the last character that is no white
    space doesn't end a sentence) or null; the first two have to be deleted.

    A conversation lies in one partition, its edits in order: an operator that
    keeps partitions may rely on it. Rows are taken by turn, nulls first, then
    role, text. A null role or text is one space, which no pattern admits and
    which is blank; a role without a character is kept nowhere either. Null ids
    are one conversation; repeated rows are duplicates. Other columns are
    ignored; an empty table has no edits.
    """
    bounded_batches(convs.sparkSession)
    ids, turns = convs.schema["conv_id"].dataType, convs.schema["turn"].dataType
    rows = convs.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    body = F.rtrim(F.col("text"), F.lit(_SPACES))
    told = rows.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), F.col("role"), F.col("text")), 256))).repartition("conv_id")
    # Partitioned by conversation already, so this window only sorts.
    seen = F.row_number().over(Window.partitionBy("conv_id", "digest").orderBy(F.asc_nulls_first("turn")))
    fault = (F.when(body == "", "blank").when(F.col("copy") > 1, "duplicate")
             .when(~F.substring(body, -1, 1).isin(".", "!", "?"), "truncated"))
    marked = told.withColumn("copy", seen).drop("digest").withColumn("fault", fault)
    order = ["role", "text", "copy"]
    last_first = marked.sortWithinPartitions("conv_id", F.desc_nulls_last("turn"), *[F.desc(c) for c in order])
    plain = "conv string, turn string, role string, text string, copy int, fault string, initial string"
    coded = last_first.select(_id_text("conv_id").alias("conv"), _id_text("turn").alias("turn"), "role", "text", "copy", "fault",
                              F.substring("role", 1, 1).alias("initial")).mapInPandas(_codes, f"{plain}, code int")
    forward = (coded.withColumn("t", _id_back("turn", turns)).sortWithinPartitions("conv", F.asc_nulls_first("t"), *order)
               .select("conv", "turn", "role", "text", "initial", "fault", "code"))
    edits = forward.mapInPandas(_edits, "conv string, at long, edit string, cost long, turn string, was string, role string, text string, fault string")
    return edits.select(_id_back("conv", ids).alias("conv_id"), "at", "edit", "cost", _id_back("turn", turns).alias("turn"), "was", "role", "text", "fault")


def _reports(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each conversation of edits that come in order."""
    columns = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    now, out = None, []
    counts: dict = {}
    cost, illegal, before, audit, digest, lines = 0, 0, None, [], hashlib.sha256(), 0
    turns, first, last = 0, 0, 0

    def report() -> None:
        if now is not None:
            gaps = last - first + 1 - turns if turns else 0
            out.append((now, gaps, *(counts.get(f, 0) for f in columns[2:5]), illegal, cost, "".join(audit), digest.hexdigest()))

    for frame in frames:
        for conv, edit, its_cost, turn, was, role, text, fault in frame[["conv", "edit", "cost", "turn", "was", "role", "text", "fault"]].itertuples(index=False, name=None):
            if now is None or conv != now:
                report()
                now, counts = conv, {}
                cost, illegal, before, audit, digest, lines = 0, 0, None, [], hashlib.sha256(), 0
                turns = 0
            if turn:
                its_turn = int(turn[1:])
                if not turns or its_turn != last:
                    first, turns = its_turn if not turns else first, turns + 1
                last = its_turn
            cost += its_cost
            audit.append(edit)
            if fault is not None:
                counts[fault] = counts.get(fault, 0) + 1
            if edit != "I":
                if before is not None and before + was[:1] not in ("su", "ua", "au"):
                    illegal += 1
                before = was[:1]
            if edit != "D":
                digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                lines += 1
        yield pd.DataFrame(out, columns=columns)
        out = []
    report()
    yield pd.DataFrame(out, columns=columns)


def damaged(convs: DataFrame) -> DataFrame:
    """``convs(conv_id, turn, role, text)`` with the faults of the registered query, dealt by crc32 of ``conv_id:turn`` (nulls: one space)."""
    word = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(word[0], F.lit(":"), word[1]).cast("binary")) % 20
    rows = convs.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_")).drop("_")


def repair_report(convs: DataFrame, broken: DataFrame) -> DataFrame:
    """One row for each conversation of ``convs`` on what it takes to repair its rows in ``broken``; the columns of the query.

    ``turn`` is an integer; the gaps are the numbers between its smallest and
    largest that no row has. A conversation without rows in ``broken`` has
    zeros, an empty audit and the digest of nothing.
    """
    ids = convs.schema["conv_id"].dataType
    edits = repair(broken).select(_id_text("conv_id").alias("conv"), "edit", "cost", _id_text("turn").alias("turn"), "was", "role", "text", "fault")
    reports = edits.mapInPandas(
        _reports, "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    every = convs.select(_id_text("conv_id").alias("conv")).distinct()
    joined = every.join(reports, "conv", "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        _id_back("conv", ids).alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
