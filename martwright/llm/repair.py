"""Conversation repair: the cheapest edits that make the turns alternate, by grammar-compressed DP.

A conversation is a sequence of symbols, one per row: the first letter of its role and whether the row
must go, is cut short or is sound. The wanted order of roles, ``(s?(ua)+)?``, is an automaton of four
states, so a row is a 4 x 4 matrix over (cost, edits): what it costs to go from one state to another by
editing this row, inserts before it included. Matrices multiply in the min-plus sense, cost first and
then the edits' letters in ASCII order.

Re-Pair finds symbol pairs that occur often in the sequences of all conversations and makes each a rule.
A rule's matrix is the product of its two halves, worked out once from the bottom up and used in every
conversation that holds the rule. The grammar is only a way to share work: whatever its size, the
product over a sequence is exact.

Equal costs over the same rows never have edits of which one begins the other (the rest would be inserts,
which cost), so the smaller letters stay smaller whatever comes before or after, and the order of
multiplication is free. Edits are ropes with a hash per node, so ties are settled without spelling out
the edits, and equal stretches are held once.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import stored

SPACES = " \t\n\x0b\x0c\r"
STOPS = ".?!"
#: Costs of the edits, and of leaving a row that is cut short.
REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
#: Rounds of Re-Pair, rules a round at most, and times that a pair must occur to become a rule.
ROUNDS, RULES, LEAST = 6, 24, 4
#: Number of matrices that a task remembers for whole sequences, and their length at most.
REMEMBERED, LONGEST = 20_000, 256

# States of the wanted order: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES, ACCEPTED = 4, (START, ASSISTANT)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLES = {"u": "user", "a": "assistant"}

#: Symbols: the role's letter, in capitals if the row is cut short; x for any other role; d must go.
TERMINALS = "suaxSUAXd"
#: Rules are characters from here on.
FIRST_RULE = 0x100

_BASE, _PRIME = 1_000_003, (1 << 61) - 1


class Rope:
    """Edits as a tree: text at the leaves, size and hash of the whole in every node."""

    __slots__ = ("left", "right", "size", "hash")

    def __init__(self, left, right=None):
        self.left, self.right = left, right
        if right is None:
            self.size, value = len(left), 0
            for c in left.encode():
                value = (value * _BASE + c) % _PRIME
            self.hash = value
        else:
            self.size = left.size + right.size
            self.hash = (left.hash * pow(_BASE, right.size, _PRIME) + right.hash) % _PRIME

    def __add__(self, other: Rope) -> Rope:
        if not self.size:
            return other
        return self if not other.size else Rope(self, other)

    def __str__(self) -> str:
        out, open_ = [], [self]
        while open_:
            node = open_.pop()
            if node.right is None:
                out.append(node.left)
            else:
                open_ += (node.right, node.left)
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        """ASCII order; equal stretches are passed over by size and hash."""
        mine, others = [self], [other]
        while mine and others:
            a, b = mine.pop(), others.pop()
            if a is b or (a.size == b.size and a.hash == b.hash):
                continue
            if a.right is not None and (a.size >= b.size or b.right is None):
                mine += (a.right, a.left)
                others.append(b)
            elif b.right is not None:
                others += (b.right, b.left)
                mine.append(a)
            else:
                same = min(a.size, b.size)
                if a.left[:same] != b.left[:same]:
                    return a.left < b.left
                if a.size > same:
                    mine.append(Rope(a.left[same:]))
                if b.size > same:
                    others.append(Rope(b.left[same:]))
        return not mine and bool(others)


Matrix = list  # STATES x STATES of (cost, Rope) or None


def times(left: Matrix, right: Matrix) -> Matrix:
    out: Matrix = []
    for row in left:
        line: list = [None] * STATES
        for k, first in enumerate(row):
            if first is None:
                continue
            for j, then in enumerate(right[k]):
                if then is None:
                    continue
                cost = first[0] + then[0]
                if line[j] is None or cost < line[j][0]:
                    line[j] = (cost, first[1] + then[1])
                elif cost == line[j][0] and (edits := first[1] + then[1]) < line[j][1]:
                    line[j] = (cost, edits)
        out.append(line)
    return out


def inserts() -> Matrix:
    """Rows put in between; going round costs and leads nowhere, so two at most."""
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    for i in range(STATES):
        out[i][i] = (0, Rope(""))
        state, n = i, 0
        while (after := STEP.get((state, "u"), STEP.get((state, "a")))) != i and n < 2:
            state, n = after, n + 1
            out[i][state] = (INSERT * n, Rope("I" * n))
    return out


def of_symbol(symbol: str) -> Matrix:
    """Inserts and then one row: kept, given another role, or deleted."""
    row: Matrix = [[None] * STATES for _ in range(STATES)]
    for i in range(STATES):
        row[i][i] = (DELETE, Rope("D"))
        if symbol == "d":
            continue
        extra = CUT_SHORT if symbol.isupper() else 0
        for role in "sua":
            if (j := STEP.get((i, role))) is None:
                continue
            if role == symbol.lower():
                row[i][j] = (extra, Rope("K"))
            elif role != "s":
                row[i][j] = (REROLE + extra, Rope("R"))
    return times(inserts(), row)


def matrices(rules: tuple[str, ...]) -> dict[str, Matrix]:
    """Matrix of every symbol, and of rule k (a pair of symbols) as character FIRST_RULE + k."""
    known = {s: of_symbol(s) for s in TERMINALS}
    for k, pair in enumerate(rules):
        known[chr(FIRST_RULE + k)] = times(known[pair[0]], known[pair[1]])
    return known


def compressed(sequence: str, rules: tuple[str, ...], first: int = 0) -> str:
    for k, pair in enumerate(rules[first:], first):
        sequence = sequence.replace(pair, chr(FIRST_RULE + k))
    return sequence


def cheapest(sequence: str, rules: tuple[str, ...], known: dict[str, Matrix]) -> tuple[int, str]:
    """Cost and letters of the cheapest edits of a sequence of symbols."""
    line = [known[s] for s in compressed(sequence, rules)]
    while len(line) > 1:  # in pairs, so that ropes stay as flat as the logarithm of the length
        odd = line[len(line) & ~1 :]
        line = [times(a, b) for a, b in zip(line[::2], line[1::2])] + odd
    whole = times(line[0], inserts()) if line else inserts()
    found = [x for j in ACCEPTED if (x := whole[START][j]) is not None]
    least = min(x[0] for x in found)
    ropes = [x[1] for x in found if x[0] == least]
    best = ropes[0]
    for rope in ropes[1:]:
        best = rope if rope < best else best
    return least, str(best)


def grammar(sequences: DataFrame, rounds: int = ROUNDS, rules: int = RULES, least: int = LEAST) -> tuple[str, ...]:
    """Re-Pair over all ``sequences`` (sequence, n): pairs of symbols, each made of earlier ones.

    A round counts the adjacent pairs of every sequence inside the tasks, adds them up per pair, and
    makes rules of the most frequent ones that share no symbol. At most ``rounds * rules`` rules come
    about, and a count per pair and task is shuffled; the best of each round reach the driver.
    """
    found: tuple[str, ...] = ()
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], first=found) -> Iterator[pa.RecordBatch]:
            seen: Counter = Counter()
            for batch in batches:
                for sequence, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    short = compressed(sequence, first)
                    for pair, times_ in Counter(zip(short, short[1:])).items():
                        seen["".join(pair)] += n * times_
            yield pa.RecordBatch.from_pydict(
                {"pair": pa.array(list(seen), pa.string()), "seen": pa.array(list(seen.values()), pa.int64())}
            )

        counted = sequences.select("sequence", "n").mapInArrow(run, "pair string, seen long")
        ranked = counted.groupBy("pair").agg(F.sum("seen").alias("seen")).where(F.col("seen") >= least)
        used: set[str] = set()
        new = []
        for pair, _seen in ranked.orderBy(F.desc("seen"), "pair").limit(4 * rules).collect():
            if not used & set(pair) and len(new) < rules:
                new.append(pair)
                used |= set(pair)
        if not new:
            break
        found += tuple(new)
    return found


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy, gone): NULL role or text is one space; crc32 of
    ``conv_id:turn`` modulo 20 drops a row, empties it, takes its stops, repeats it or makes it a
    user's."""
    blank = F.lit(" ")
    part = lambda c: F.coalesce(F.col(c).cast("string"), blank)
    harm = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    role, text = part("role"), part("text")
    text = F.when(harm == 1, F.lit("")).when(harm == 2, F.translate(text, STOPS, "")).otherwise(text)
    role = F.when(harm == 4, F.lit("user")).otherwise(role)
    copies = F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"), (harm == 0).alias("gone")
    )


def marked(rows: DataFrame) -> DataFrame:
    """Rows with a digest of their text, ``blank`` and ``cut`` (cut short)."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    return rows.withColumns(
        {
            "digest": F.sha2(F.col("text").cast("binary"), 256),
            "blank": trimmed == "",
            "cut": ~F.right(trimmed, F.lit(1)).isin(*STOPS),
        }
    )


def with_repeats(rows: DataFrame) -> DataFrame:
    """Adds ``again``: a row of an earlier turn has the same role and text. (Equal rows of one turn lie
    side by side in order and are told there.)

    The earliest turn is found per distinct row, and only rows that several turns have are joined; they
    are stored first, so that a very frequent one does not make a hot task.
    """
    present = rows.where("not gone and not blank")
    earliest = present.groupBy("conv_id", "role", "digest").agg(
        F.min("turn").alias("first"),
        F.max("turn").alias("last"),
        (F.count_if(F.col("turn").isNull()) > 0).alias("unnumbered"),
    )
    several = earliest.where("first < last or (unnumbered and last is not null)").drop("last")
    several = stored(several.toDF("of_conv", "of_role", "of_digest", "first", "unnumbered"), "repeated")
    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("role") == F.col("of_role"))
    again = F.col("unnumbered") | (F.col("turn") > F.col("first"))
    return rows.join(several, same & (F.col("digest") == F.col("of_digest")), "left").select(
        *rows.columns, F.coalesce(F.col("turn").isNotNull() & again, F.lit(False)).alias("again")
    )


ORDER = ["turn", "role", "digest", "copy"]


def in_order(rows: DataFrame, *before: str) -> DataFrame:
    """All rows of a conversation in one partition and in order, turns without number first."""
    order = [F.asc_nulls_first(c) for c in ("conv_id", *before, *ORDER)]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]


class Reader:
    """Symbols and counts of one conversation, from its rows in order."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.symbols: list[str] = []
        self.n = dict.fromkeys(COUNTS, 0)
        self.low = self.high = self.before = self.letter = None
        self.turns = 0

    def row(self, turn, role: str, digest: str, blank: bool, cut: bool, again: bool) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        letter = role[0] if role and role[0] in "sua" else "x"
        if blank:
            fault = "blank"
        elif again or self.before == (turn, role, digest):
            fault = "duplicate"
        else:
            fault = "truncated" if cut else None
        if fault:
            self.n[fault] += 1
        self.symbols.append("d" if fault in ("blank", "duplicate") else letter.upper() if fault else letter)
        if self.letter is not None and self.letter + letter not in ("su", "ua", "au"):
            self.n["illegal"] += 1
        self.before, self.letter = (turn, role, digest), letter

    def result(self) -> tuple:
        if self.turns:
            self.n["gaps"] = self.high - self.low + 1 - self.turns
        return (self.conv_id, "".join(self.symbols), *self.n.values())


class Replay:
    """Carries out the edits of one conversation on its rows in order, and digests what comes out."""

    def __init__(self, conv_id, plan: dict):
        self.conv_id, self.plan, self.edits = conv_id, plan, plan["audit"]
        self.at, self.state, self.digest = 0, START, hashlib.sha256()

    def put(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.state == START else chr(10)}{role}:{text}".encode())
        self.state = STEP[self.state, role[0]]

    def wanted(self) -> str:
        return ROLES["a" if self.state == USER else "u"]

    def inserts(self) -> None:
        while self.edits.startswith("I", self.at):
            self.put(self.wanted(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.edits[self.at]
        self.at += 1
        if edit != "D":
            self.put(role if edit == "K" else self.wanted(), text)

    def result(self) -> tuple:
        self.inserts()
        return self.conv_id, self.plan, self.digest.hexdigest()


def batches_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def sequences(rows: DataFrame) -> DataFrame:
    """(conv_id, sequence, counts) per conversation. Rows pass as a stream: of a conversation only its
    symbols are held, a byte a row. One of which all rows are gone has no symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, schema = None, [], None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            schema = pa.schema([("conv_id", kind), ("sequence", pa.string()), *((c, pa.int64()) for c in COUNTS)])
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "gone", *ORDER[:3], "blank", "cut", "again")]
            for conv, gone, *row in zip(*columns):
                if now is None or conv != now.conv_id:
                    done += [now.result()] if now else []
                    now = Reader(conv)
                if not gone:
                    now.row(*row)
            if done:
                yield batches_of(done, schema)
                done = []
        if now:
            yield batches_of([now.result()], schema)

    kind = rows.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, sequence string, {', '.join(f'{c} long' for c in COUNTS)}"
    return in_order(rows).mapInArrow(run, ddl)


def solved(found: DataFrame, rules: tuple[str, ...]) -> DataFrame:
    """(conv_id, plan): the counts with the cost and letters of the cheapest edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = matrices(rules)
        recent = lru_cache(REMEMBERED)(lambda s: cheapest(s, rules, known))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            best = [recent(s) if len(s) <= LONGEST else cheapest(s, rules, known) for s in texts]
            cost, audit = pa.array([b[0] for b in best], pa.int64()), pa.array([b[1] for b in best], pa.string())
            plan = pa.StructArray.from_arrays([*batch.columns[2:], cost, audit], names=[*COUNTS, "cost", "audit"])
            yield pa.RecordBatch.from_arrays([batch.column(0), plan], names=["conv_id", "plan"])

    kind = found.schema["conv_id"].dataType.simpleString()
    plan = ", ".join(f"{c}: bigint" for c in [*COUNTS, "cost"])
    return found.mapInArrow(run, f"conv_id {kind}, plan struct<{plan}, audit: string>")


def replayed(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, plan, repaired_sha256): each plan is sorted in front of its conversation's rows, which
    then stream by."""
    null = lambda c: F.lit(None).cast(c)
    body = rows.where("not gone").select(
        "conv_id", F.lit(1).alias("kind"), null(plans.schema["plan"].dataType).alias("plan"), *ORDER, "text"
    )
    fields = {f.name: f.dataType for f in body.schema}
    head = plans.select(
        "conv_id", F.lit(0).alias("kind"), "plan", *(null(fields[c]).alias(c) for c in [*ORDER, "text"])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, schema = None, [], None
        for batch in batches:
            of = batch.schema
            schema = pa.schema([of.field("conv_id"), of.field("plan"), ("repaired_sha256", pa.string())])
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "kind", "plan", "role", "text")]
            for conv, kind, plan, role, text in zip(*columns):
                if kind:
                    now.row(role, text)
                else:
                    done += [now.result()] if now else []
                    now = Replay(conv, plan)
            if done:
                yield batches_of(done, schema)
                done = []
        if now:
            yield batches_of([now.result()], schema)

    names = ", ".join(f"{c} {fields[c].simpleString()}" for c in ("conv_id", "plan"))
    return in_order(head.unionByName(body), "kind").mapInArrow(run, f"{names}, repaired_sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """Per conversation: the counts of ``COUNTS``, cost and audit (letters of the cheapest edits) and the
    SHA-256 of the repaired rows.

    ``conversations``: (conv_id, turn, role, text, gone, copy) as ``damaged`` makes them; ``gone`` rows
    only tell that their conversation exists. Rows go by turn, NULL first; rows of one turn by role, then
    digest of the text, copies last. NULL conv_ids are one conversation. A conversation without rows has
    zeros, an empty audit and the digest of nothing. Texts and conversations of any length pass as a
    stream; a conversation's digest is sequential, so its rows pass through one task. Other columns are
    not looked at; an empty frame gives an empty frame.
    """
    rows = stored(marked(conversations), "rows")
    found = stored(sequences(with_repeats(rows.drop("text"))), "sequences")
    shapes = stored(found.groupBy("sequence").agg(F.count(F.lit(1)).alias("n")), "shapes")
    plans = solved(found, grammar(shapes))
    return replayed(rows, plans).select("conv_id", "plan.*", "repaired_sha256")
