"""Conversation structure repair: the cheapest edits that make a conversation an optional system turn and user/assistant pairs.

Rows stand in the order of their turns (null first; rows of one turn by role and digest of the text). The role initials of a
repaired conversation are ``(s?(ua)+)?``. Edits: Keep 0, Rerole to user or assistant 3, Delete 4 (all a blank or repeated row
allows), Insert an empty user or assistant turn 3; a truncated row that stays adds 3. Of the cheapest edits those whose
initials are least in ASCII order are taken.

1. ``plan``: rows without their text go to their conversation's partition, sorted by turn from the last to the first. A stream
   carries the cost to the end from each of four automaton states across Arrow batches, and per row keeps one byte: the
   best edit of each state. After every ``block`` rows the bytes leave the task as a row and are written to the shared folder,
   so a giant conversation holds one block in memory.
2. ``repaired`` and ``report``: rows with their text, sorted forward behind their conversation's bytes, follow the
   edits from the start state. Texts stream through; memory holds the bytes and edit initials of one conversation, one each a row.

Defined cases: null role or text is one space; a null conv_id is a conversation of its own; a null turn comes first and leaves no
gap; repeated rows are repeated turns (the later ones are duplicates); other columns are ignored; no rows, no conversations.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftwood.llm.store import stored

#: rows whose edits travel as one
BLOCK = 1 << 18
#: blank characters: 0x20 and 0x09-0x0D
BLANKS = " \t\n\x0b\x0c\r"
INITIALS, EDITS = ".sua", "DIKR"
FAULTS = ("", "blank", "duplicate", "truncated")
# states: 0 start, 1 after the system turn, 2 after a user turn, 3 after an assistant turn; it may end in 0 and 3
_SPOKEN = (2, 2, 3, 2)
_KEPT = {(0, 1): 1, (0, 2): 2, (1, 2): 2, (3, 2): 2, (2, 3): 3}
_END = (0, 6, 3, 0)
_LEGAL = {(1, 2), (2, 3), (3, 2)}
_ROLE = {2: "user", 3: "assistant"}
PLAN = "conv string, block int, edits binary, report array<bigint>"
REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged(rows: DataFrame) -> DataFrame:
    """Faults put into conv_id, turn, role, text by crc32 of ``conv_id:turn`` modulo 20: 0 marks the row as dropped, 1 empties its text,
    2 removes its ``[.!?]``, 3 repeats it, 4 sets its role to user. ``dropped`` says whether a row is gone."""
    blank = F.lit(" ")
    kind = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(text)
    out = rows.select("conv_id", "turn", "role", "text", kind.alias("kind"))
    out = out.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"), text.alias("text"), "kind")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return out.withColumn("copy", F.explode(copies)).select("conv_id", "turn", "role", "text", (F.col("kind") == 0).alias("dropped"))


def _rows(rows: DataFrame) -> DataFrame:
    blank = F.lit(" ")
    gone = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    text = F.coalesce(F.col("text").cast("string"), blank)
    # a key that is never null, as nulls change their form on the way to Python
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    return rows.select(conv.alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), blank).alias("role"),
                       text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), gone.alias("dropped"))


def _named(found: DataFrame, rows: DataFrame) -> DataFrame:
    """conv_id as ``rows`` has it."""
    back = F.when(F.col("conv_id") != "", F.expr("substring(conv_id, 2)"))
    return found.withColumn("conv_id", back.cast(rows.schema["conv_id"].dataType))


def _fault(text: Column, seen: Column) -> Column:
    """Index into FAULTS of a row's first fault."""
    bare = F.rtrim(text, F.lit(BLANKS))
    return F.when(bare == "", 1).when(seen, 2).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)


@lru_cache(maxsize=1 << 16)
def _step(after: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int, int]:
    """Costs to the end before a row from those after it (less their minimum), that minimum, and the byte of best edits."""
    initial, fault = code & 3, code >> 2
    late = 3 if fault == 3 else 0
    options: list[list[tuple[int, int]]] = []
    for s in range(4):
        o = [(4 + after[s], 0)]
        if fault not in (1, 2):
            o.append((3 + late + after[_SPOKEN[s]], 3))
            if (s, initial) in _KEPT:
                o.append((late + after[_KEPT[s, initial]], 2))
        options.append(o)
    own = [min(o)[0] for o in options]
    best = [0, 0, min(own[2], 3 + own[3]), min(own[3], 3 + own[2])]
    best[0], best[1] = min(own[0], 3 + best[2]), min(own[1], 3 + best[2])
    edits = 0
    for s in range(4):
        edits |= min(e for c, e in [*options[s], (3 + best[_SPOKEN[s]], 1)] if c == best[s]) << 2 * s
    least = min(best)
    return tuple(c - least for c in best), least, edits


def _backward(batches, block: int):
    """Streams (conv, code, turn, dated) from a conversation's last row to its first: PLAN rows. The code -1 is a dropped row."""
    name, open_ = None, False
    costs, total, held, blocks = _END, 0, bytearray(), 0
    later, least, most, turns, counts, illegal = None, None, None, 0, [0] * 4, 0

    def close():
        gaps = most - least + 1 - turns if turns else 0
        return name, blocks, bytes(held[::-1]), [gaps, *counts[1:], illegal, costs[0] + total]

    for pdf in batches:
        out = []
        for conv, code, turn, dated in zip(pdf["conv"], pdf["code"].tolist(), pdf["turn"].tolist(), pdf["dated"].tolist()):
            if not open_ or conv != name:
                if open_:
                    out.append(close())
                name, open_ = conv, True
                costs, total, held, blocks = _END, 0, bytearray(), 0
                later, least, most, turns, counts, illegal = None, None, None, 0, [0] * 4, 0
            if code < 0:
                continue
            costs, more, edits = _step(costs, code)
            total += more
            held.append(edits)
            counts[code >> 2] += 1
            if later is not None and (code & 3, later) not in _LEGAL:
                illegal += 1
            later = code & 3
            if dated and turn != least:
                least, turns = turn, turns + 1
                most = turn if most is None else most
            if len(held) >= block:
                out.append((name, blocks, bytes(held[::-1]), None))
                held, blocks = bytearray(), blocks + 1
        if out:
            yield pd.DataFrame(out, columns=["conv", "block", "edits", "report"])
    if open_:
        yield pd.DataFrame([close()], columns=["conv", "block", "edits", "report"])


def plan(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The edits of every conversation of ``rows`` (conv_id, turn, role, text, perhaps dropped) in blocks, the report in its last one."""
    own = _rows(rows).repartition("conv")
    seen = F.row_number().over(W.partitionBy("conv", "dropped", "role", "digest").orderBy(F.col("turn").asc_nulls_first()))
    first = F.instr(F.lit(INITIALS[1:]), F.left("role", F.lit(1)))
    code = F.when(F.col("dropped"), -1).otherwise(F.when(F.col("role") == "", 0).otherwise(first) + 4 * _fault(F.col("text"), F.col("copy") > 1))
    own = own.withColumn("copy", seen).select("conv", "turn", "role", "digest", "copy", code.cast("int").alias("code"))
    down = own.sortWithinPartitions("conv", F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("digest").desc(), F.col("copy").desc())
    light = down.select("conv", "code", F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNotNull().alias("dated"))
    return stored(light.mapInPandas(lambda batches: _backward(batches, block), PLAN), "conversation-plan")


def _forward(batches):
    """Streams a conversation's blocks, then its rows: ("open", conv, report), then ("D" | "I" | "K" | "R", role, text) for each edit, then ("close",)."""
    name, open_, state, edits, at, report = None, False, 0, b"", 0, None

    def rest(state):
        while state in (1, 2):
            state = _SPOKEN[state]
            yield "I", _ROLE[state], ""
        yield ("close",)

    for pdf in batches:
        for conv, role, text, more, told in zip(pdf["conv"], pdf["role"], pdf["text"], pdf["edits"], pdf["report"]):
            if not open_ or conv != name:
                if open_:
                    yield from rest(state)
                name, open_, state, edits, at = conv, True, 0, bytearray(), 0
                yield "open", conv, [int(x) for x in told]
            if more is not None:
                edits += more
                continue
            byte = edits[at]
            at += 1
            while (e := byte >> 2 * state & 3) == 1:
                state = _SPOKEN[state]
                yield "I", _ROLE[state], ""
            if e == 2:
                state = _KEPT[state, INITIALS.find(role[:1])]
            elif e == 3:
                state = _SPOKEN[state]
                role = _ROLE[state]
            yield EDITS[e], role, text
        yield ("batch",)
    if open_:
        yield from rest(state)


def _beside(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Every conversation's blocks, from the last written to the first, then its rows in order."""
    own = _rows(rows).filter("NOT dropped").drop("dropped").withColumns({"edits": F.lit(None).cast("binary"), "report": F.lit(None).cast("array<bigint>"), "block": F.lit(-1)})
    blocks = plan.select("conv", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(None).cast("binary").alias("digest"), "edits", "report", "block")
    both = own.unionByName(blocks).repartition("conv")
    sorted_ = both.sortWithinPartitions("conv", F.col("block").desc(), F.col("turn").asc_nulls_first(), "role", "digest")
    return sorted_.select("conv", "role", "text", "edits", "report")


def repaired(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (K, R or I), role and text."""
    def run(batches):
        out: list[tuple] = []
        conv, place = None, 0
        for kind, *rest in _forward(batches):
            if kind == "open":
                conv, place = rest[0], 0
            elif kind in ("I", "K", "R"):
                out.append((conv, place, kind, *rest))
                place += 1
            elif kind == "batch" and out:
                yield pd.DataFrame(out, columns=["conv_id", "place", "edit", "role", "text"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=["conv_id", "place", "edit", "role", "text"])

    found = _beside(rows, plan).mapInPandas(run, "conv_id string, place bigint, edit string, role string, text string")
    return _named(found, rows)


def report(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """conv_id, REPORT, audit (the edits' initials) and repaired_sha256 (of ``role:text`` lines) of every conversation."""
    names = ["conv_id", *REPORT, "audit", "repaired_sha256"]

    def run(batches):
        out: list[tuple] = []
        conv, told, audit, digest, lines = None, None, [], hashlib.sha256(), 0
        for kind, *rest in _forward(batches):
            if kind == "open":
                conv, told = rest
                audit, digest, lines = [], hashlib.sha256(), 0
            elif kind == "close":
                out.append((conv, *told, "".join(audit), digest.hexdigest()))
            elif kind == "batch":
                if out:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            else:
                audit.append(kind)
                if kind != "D":
                    digest.update(f"{chr(10) if lines else ''}{rest[0]}:{rest[1]}".encode())
                    lines += 1
        if out:
            yield pd.DataFrame(out, columns=names)

    kinds = ", ".join(f"{x} bigint" for x in REPORT)
    found = _beside(rows, plan).mapInPandas(run, f"conv_id string, {kinds}, audit string, repaired_sha256 string")
    return _named(found, rows)
