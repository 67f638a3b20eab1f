"""Cheapest repair of conversations over a suffix-shared automaton.

Every row of a conversation becomes a letter: its role's initial, or ``x`` where it has to go (blank or said
before); upper case if it is truncated. A conversation's letters are cut into segments of ``SEGMENT`` counted from
its end. The segments of all conversations together form a suffix-shared automaton: a node is a distinct
suffix, and it leads to the node of the suffix without its first letter. Level by level, from the end, each node gets
for each state of the grammar the cheapest cost to go and the least audit text, once, however many conversations
run through it. A conversation of one segment reads its answer from its node. A longer one is put together
from its segments' tables, which hold the cost from each state to each state.

The grammar ``(s?(ua)+)?`` has the states 0 beginning, 1 after ``s``, 2 after ``u``, 3 after ``a``; 0 and 3 may end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourpanel.llm.text import map_batches
from hourpanel.session import materialise

SEGMENT = 16  # letters of a segment; also the deepest level of the automaton
STATES = range(4)
# Costs of the edits, and the grammar.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
AFTER = {0: 2, 1: 2, 2: 3, 3: 2}  # the state after an inserted or rerolled row
ROLE_OF = {0: "user", 1: "user", 2: "assistant", 3: "user"}  # and that row's role
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
LEGAL = ("su", "ua", "au")
CLOSING = {0: (0, ""), 1: (10, "II"), 2: (5, "I"), 3: (0, "")}  # what remains to be inserted at the end of a conversation
END = "end"  # the tail of a conversation's last segment; "0" to "3": only that state counts

_BLANK = r"[^\x20\x09-\x0D]"
_NODE = "struct<cost:bigint,audit:string>"


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, times) after the damage; equal rows of a conversation and turn are one with a number."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return (
        rows.where(kind != 0)
        .select(F.col("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("n"))
        .groupBy("conv_id", "turn", "role", "text")
        .agg(F.sum("n").alias("times"))
    )


def _marked(rows: DataFrame) -> DataFrame:
    """Rows in order (``at`` ascends) with blank, said (an earlier turn has the same role and text) and truncated."""
    keys = ["conv_id", "turn", "role", "text"]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)  # a long conversation spreads over ranges
    sha = F.sha2(F.concat(F.col("role"), F.lit("\0"), F.col("text")), 256)
    shown = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    placed = materialise(
        placed.select(
            *keys, "times", F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("part"), sha.alias("said_key"),
            (~F.col("text").rlike(_BLANK)).alias("blank"), (~shown.rlike(r"[.!?]\z")).alias("truncated"),
        ),
        "conversation_rows",
    )
    again = placed.groupBy("conv_id", "said_key").agg(F.min("at").alias("first_at"), F.count("*").alias("c")).where("c > 1")
    again = materialise(again.select(F.col("conv_id").alias("a_conv"), F.col("said_key").alias("a_key"), "first_at"), "conversation_repeats")
    same = F.col("conv_id").eqNullSafe(F.col("a_conv")) & (F.col("said_key") == F.col("a_key"))
    return placed.join(again, same, "left").withColumn("said", F.coalesce(F.col("at") > F.col("first_at"), F.lit(False))).drop("a_conv", "a_key", "first_at", "said_key")


def _segments(marked: DataFrame) -> DataFrame:
    """(conv_id, part, segment, first_at, letters, last): letters in order, segments counted from the end of a part of a conversation."""
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    letter = F.when(F.col("blank") | F.col("said"), F.lit("x")).when(F.col("truncated"), F.upper(letter)).otherwise(letter)
    each = marked.select("conv_id", "part", "at", letter.alias("letter"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy"))
    each = each.withColumn("letter", F.when(F.col("copy") > 1, F.lit("x")).otherwise(F.col("letter")))  # a copy was said before
    order = Window.partitionBy("conv_id", "part").orderBy(F.desc("at"), F.desc("copy"))  # no more rows than a range has
    each = each.withColumn("segment", F.floor((F.row_number().over(order) - 1) / SEGMENT))
    held = F.sort_array(F.collect_list(F.struct("at", "copy", "letter")))  # SEGMENT letters at most
    return each.groupBy("conv_id", "part", "segment").agg(held.alias("held")).select(
        "conv_id", "part", "segment", F.array_join("held.letter", "").alias("letters")
    )


def _option(ok, cost, letter: str, rest: Column) -> Column:
    made = F.struct((F.lit(cost) + rest["cost"]).cast("bigint").alias("cost"), F.concat(F.lit(letter), rest["audit"]).alias("audit"))
    return F.when(ok & rest["cost"].isNotNull(), made)


def _least(options: list[Column]) -> Column:
    """The cheapest, ties to the least text; null if there is none."""
    return F.least(*options) if len(options) > 1 else options[0]


def _through(letter: Column, rest: dict[int, Column]) -> dict[int, Column]:
    """Cheapest (cost, audit) from each state through a row's ``letter`` into the node behind it, which has ``rest``."""
    must_go, extra = letter == "x", F.when(letter.rlike("[SUAO]"), TRUNCATED).otherwise(0)
    plain = F.lower(letter)
    direct = {}
    for state in STATES:
        options = [_option(F.lit(True), DELETE, "D", rest[state]), _option(~must_go, extra + REROLE, "R", rest[AFTER[state]])]
        options += [_option(plain == role, extra + KEEP, "K", rest[then]) for (own, role), then in KEPT.items() if own == state]
        direct[state] = _least(options)
    out = {}
    for state in STATES:
        once = AFTER[state]
        twice = AFTER[once]  # a third insertion would come back to a state that was left
        out[state] = _least([direct[state], _option(F.lit(True), INSERT, "I", direct[once]), _option(F.lit(True), 2 * INSERT, "II", direct[twice])])
    return out


def automaton(segments: DataFrame) -> DataFrame:
    """The nodes of all segments (letters, tail): their suffix and tail with ``to_0`` to ``to_3``, the best (cost, audit) from each state.

    One level a step, at most SEGMENT of them; a node is worked out once and found by the node before it.
    """
    cuts = F.explode(F.sequence(F.lit(1), F.length("letters")))
    nodes = segments.select("letters", "tail").distinct().select("tail", F.expr("letters").alias("letters"), cuts.alias("i"))
    nodes = materialise(nodes.select("tail", F.expr("substring(letters, i)").alias("suffix")).distinct().withColumn("depth", F.length("suffix")), "automaton_nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    ends = []
    for tail in (END, *map(str, STATES)):
        pairs = [CLOSING[s] if tail == END else (0, "") if tail == str(s) else (None, None) for s in STATES]
        ends.append((tail, "", *pairs))
    schema = "tail string, suffix string, " + ", ".join(f"to_{s} {_NODE}" for s in STATES)
    level = nodes.sparkSession.createDataFrame(ends, schema)
    levels = []
    for depth in range(1, deepest + 1):
        behind = level.select(F.col("tail").alias("b_tail"), F.col("suffix").alias("b_suffix"), *(F.col(f"to_{s}").alias(f"rest_{s}") for s in STATES))
        own = nodes.where(F.col("depth") == depth).select("tail", "suffix")
        joined = own.join(behind, (F.col("tail") == F.col("b_tail")) & (F.expr("substring(suffix, 2)") == F.col("b_suffix")))
        best = _through(F.substring("suffix", 1, 1), {s: F.col(f"rest_{s}") for s in STATES})
        level = materialise(joined.select("tail", "suffix", *(best[s].alias(f"to_{s}") for s in STATES)), "automaton_level")
        levels.append(level)
    return reduce(DataFrame.unionByName, levels) if levels else level.where("suffix <> ''")


def _chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From segments of long conversations, last one first: the cheapest audit of each, in the order of the rows.

    Costs run from the end to the beginning; what each state would do is held per segment, 4 numbers and texts,
    until the beginning shows which state is met.
    """
    key, held, cost = None, [], None
    out: list[tuple] = []

    def close() -> None:
        state, audit = 0, []
        for choice in reversed(held):
            _, text, state = choice[state]
            audit.append(text)
        out.append((key[0], cost[0], "".join(audit)))

    for batch in batches:
        for row in batch.to_pylist():
            own = (row["conv_id"],)
            if own != key:
                if key is not None:
                    close()
                key, held, cost = own, [], [CLOSING[s][0] for s in STATES]
                closing = [CLOSING[s][1] for s in STATES]
            choice = []
            for state in STATES:
                options = []
                for then in STATES:
                    entry = row[f"from_{then}"][state]
                    if entry is not None and entry["cost"] is not None:
                        options.append((entry["cost"] + cost[then], entry["audit"] + (closing[then] if not held else ""), then))
                choice.append(min(options))
            held.append(choice)
            cost = [c[0] for c in choice]
        if out:
            yield _audits(out)
            out = []
    if key is not None:
        close()
        yield _audits(out)


def _audits(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows])], ["conv_id", "cost", "audit"])


def audits(marked: DataFrame) -> DataFrame:
    """(conv_id, cost, audit) of every conversation that has rows."""
    segments = materialise(_segments(marked), "conversation_segments")
    many = segments.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1")
    many = materialise(many.select(F.col("conv_id").alias("m_conv")), "long_conversations")  # more than SEGMENT rows, or cut by a range
    same = F.col("conv_id").eqNullSafe(F.col("m_conv"))
    long = segments.join(many, same, "left_semi")
    short = segments.join(many, same, "left_anti")
    tails = [short.select("letters", F.lit(END).alias("tail"))] + [long.select("letters", F.lit(str(s)).alias("tail")) for s in STATES]
    nodes = materialise(automaton(reduce(DataFrame.unionByName, tails)), "automaton")
    ends = nodes.where(F.col("tail") == END).select("suffix", "to_0")
    direct = short.join(ends, short["letters"] == ends["suffix"]).select(F.col("conv_id").cast("long").alias("conv_id"), "to_0.cost", "to_0.audit")
    tables = nodes.where(F.col("tail") != END).groupBy("suffix").agg(
        *(F.max(F.when(F.col("tail") == str(s), F.array(*(f"to_{x}" for x in STATES)))).alias(f"from_{s}") for s in STATES)
    )
    parts = long.join(tables, long["letters"] == tables["suffix"]).select("conv_id", "part", "segment", *(f"from_{s}" for s in STATES))
    order = parts.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), "segment")
    return direct.unionByName(map_batches(order, _chosen, "conv_id long, cost long, audit string"))


_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation, from a stream of its audit and then its rows in order. A repaired text is hashed as it is made, not held."""
    key, one, out = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = (row["conv_id"],)
            if own != key:
                if one is not None:
                    out.append(one.result(key[0]))
                key, one = own, _Repair()
            one.take(row)
        if out:
            yield pa.RecordBatch.from_pylist(out, _schema())
            out = []
    if one is not None:
        yield pa.RecordBatch.from_pylist([one.result(key[0])], _schema())


def _schema() -> pa.Schema:
    names = [x.split() for x in _RESULT.split(", ")]
    return pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in names])


class _Repair:
    def __init__(self):
        self.audit, self.cost, self.at, self.state = "", 0, 0, 0
        self.hash, self.written = hashlib.sha256(), False
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.before = self.low = self.high = None
        self.turns = 0

    def _write(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) * self.written}{role}:{text}".encode("utf-8", "replace"))
        self.written = True

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._write(ROLE_OF[self.state], "")
            self.state, self.at = AFTER[self.state], self.at + 1

    def _edit(self, role: str, text: str) -> None:
        self._inserts()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self._write(role, text)
            self.state = KEPT[self.state, role[0]]
        elif edit == "R":
            self._write(ROLE_OF[self.state], text)
            self.state = AFTER[self.state]

    def take(self, row: dict) -> None:
        if row["at"] < 0:
            if row["audit"] is not None:
                self.audit, self.cost = row["audit"], row["cost"]
            return
        turn, initial, times, counts = row["turn"], row["role"][:1], row["times"], self.counts
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        if self.before is not None and self.before + initial not in LEGAL:
            counts["illegal"] += 1
        self.before = initial
        counts["illegal"] += times - 1  # a role does not follow itself
        first = "blank" if row["blank"] else "duplicate" if row["said"] else "truncated" if row["truncated"] else None
        if first:
            counts[first] += 1
        counts["blank" if row["blank"] else "duplicate"] += times - 1
        for _ in range(times):
            self._edit(row["role"], row["text"])

    def result(self, conv_id) -> dict:
        self._inserts()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv_id": conv_id, "gaps": gaps, **self.counts, "cost": self.cost, "audit": self.audit, "repaired_sha256": self.hash.hexdigest()}


def repair(rows: DataFrame) -> DataFrame:
    """Per original conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` has conv_id, turn, role, text; other columns are ignored. A null conversation is one of its own;
    null turns come first; a null role or text is one space. Rows of one turn are taken by role, then text; equal
    rows side by side. An empty text is blank. Conversations without rows after the damage have zeros, an empty audit and the
    hash of the empty text. A conversation's audit is one cell, and its hash runs over its rows in turn, so one task reads
    them as a stream and holds the audit but no rows; all else of a long conversation is spread.
    """
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    marked = materialise(_marked(damaged(plain)), "conversations_marked")
    found = materialise(audits(marked), "conversation_audits")
    head = plain.select("conv_id").distinct().select("conv_id", F.lit(-2).cast("long").alias("at")).unionByName(found.withColumn("at", F.lit(-1).cast("long")), allowMissingColumns=True)
    stream = head.unionByName(marked.drop("part"), allowMissingColumns=True)
    order = stream.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    return map_batches(order, _repaired, _RESULT)
