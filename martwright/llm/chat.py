"""Chat formatting as a prefix tree of turns.

Conversations that begin with the same turns share nodes. A node is named by a digest of its turn and
its parent's name, so equal beginnings meet without comparing conversations. Every node's tokens are
written once, depth-first: nodes are ordered by the choices at the branching turns above them, then by
depth. Each node carries the position of its first token in any conversation through it, and the token
intervals of itself and its ancestors, which are all it may attend to.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and texts a backslash is doubled and every
control string gets a backslash after its first character, so none is left; ``unescape`` drops one
backslash before any character.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import stored
from martwright.llm.tokens import plain_tokenizer, vocabulary

START, END = "<|im_start|>", "<|im_end|>"
CONTROLS = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LEARNED_ROLE = "assistant"
#: Turns that a worker encodes or decodes together; bounds its memory, not the result.
TOGETHER = 500
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for control in CONTROLS:
        text = text.replace(control, f"{control[0]}\\{control[1:]}")
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text, the escaped text, and what ends the turn."""
    return f"{START}{escape(role).replace(chr(10), chr(92) + chr(10))}\n", escape(text), f"{END}\n"


def parse_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of one formatted turn."""
    if not formatted.startswith(START) or not formatted.endswith(f"{END}\n"):
        raise ValueError("not a formatted turn")
    body = formatted[len(START) : -len(END) - 1]
    head = re.match(r"((?:[^\\\n]|\\.)*)\n", body, re.S)
    return unescape(head[1]), unescape(body[head.end() :])


def _name(parent: bytes, role: str, text: str) -> bytes:
    role_bytes = role.encode()
    digest = hashlib.blake2b(parent, digest_size=16)
    digest.update(len(role_bytes).to_bytes(8, "little") + role_bytes + text.encode())
    return digest.digest()


def _in_order(df: DataFrame, *order: str) -> DataFrame:
    """Each conversation's rows together and in order, to be streamed; none is held as a whole."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, idx, node, parent, role, text): each turn with the name of its prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, idx, parent = (), 0, b""
        for batch in batches:
            rows: list[list] = [[], [], []]
            for conv_id, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (conv_id,) != now:
                    now, idx, parent = (conv_id,), 0, b""
                node = _name(parent, role, text)
                for column, value in zip(rows, (idx, node, parent)):
                    column.append(value)
                idx, parent = idx + 1, node
            kinds = (pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(r, k) for r, k in zip(rows, kinds)), *batch.columns[1:3]],
                names=["conv_id", "idx", "node", "parent", "role", "text"],
            )

    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        "turn",
    )
    return _in_order(rows, "turn", "role", "text").mapInArrow(
        run, "conv_id long, idx int, node binary, parent binary, role string, text string"
    )


def _ordered(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, idx, node, parent) with ``choices``: the branches taken, 8 bytes each.

    Only turns whose parent branches add a choice, so the key stays short in a long conversation.
    """
    edges = rows.select("parent", "node").distinct()
    branching = edges.groupBy("parent").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    branching = branching.withColumn("branches", F.lit(True))
    flagged = rows.join(branching, "parent", "left").select("conv_id", "idx", "node", "branches")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        choices = b""
        for batch in batches:
            found: list[bytes] = []
            for idx, node, branches in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                if idx == 0:
                    choices = node[:8]
                elif branches:
                    choices += node[:8]
                found.append(choices)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(found, pa.binary())],
                names=["idx", "node", "choices"],
            )

    return _in_order(flagged, "idx").mapInArrow(run, "idx int, node binary, choices binary")


def build_tree(conversations: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(tree, members), two tables in the shared folder.

    tree, one row per distinct conversation prefix, in depth-first order by ``start``: node, parent,
    idx (turn number), start (place of its first token in the emission), n_tokens, ids (packed unsigned
    16-bit), loss_from and loss_to (tokens of the node under the loss mask, equal if none), position (id
    of its first token within a conversation), attends (intervals of tokens it sees, its own last).
    members: conv_id, idx, node.

    A conversation's rows are ordered by turn, role and text; NULL role or text is empty, rows with
    NULL conv_id are one conversation, repeated rows are turns of their own. No row is dropped.
    """
    path = path or vocabulary("byte_bpe_50k.json")
    rows = stored(turns(conversations), "turns")
    members = rows.select("conv_id", "idx", "node")
    order = _ordered(rows.select("conv_id", "idx", "node", "parent")).dropDuplicates(["node"])
    texts = rows.select("node", "parent", "role", "text").dropDuplicates(["node"])
    nodes = texts.join(order, "node")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["choices", "idx", "node"]
    sorted_nodes = stored(nodes, "nodes").repartitionByRange(parts, *keys).sortWithinPartitions(*keys)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = plain_tokenizer(path)
        part, at = TaskContext.get().partitionId(), 0
        for batch in (b.slice(low, TOGETHER) for b in batches for low in range(0, b.num_rows, TOGETHER)):
            split = [turn_parts(r, t) for r, t in zip(*(batch.column(k).to_pylist() for k in (2, 3)))]
            parts = list({x for s in split for x in s})  # of heads and tails there are few
            coded = tokenizer.encode_batch_fast(parts, add_special_tokens=False)
            ids_of = dict(zip(parts, (e.ids for e in coded)))
            out: list[list] = [[] for _ in range(5)]
            for role, texts in zip(batch.column(2).to_pylist(), split):
                head, body, tail = map(ids_of.__getitem__, texts)
                ids = np.array([*head, *body, *tail], "<u2")
                learned = len(body) if role == LEARNED_ROLE else 0
                row = (at, len(ids), ids.tobytes(), len(head), len(head) + learned)
                for column, value in zip(out, row):
                    column.append(value)
                at += len(ids)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * batch.num_rows, pa.int32()),
                    batch.column(0),
                    batch.column(1),
                    batch.column(4),
                    *(pa.array(c, k) for c, k in zip(out, kinds)),
                ],
                names=["part", "node", "parent", "idx", "at", "n_tokens", "ids", "loss_from", "loss_to"],
            )

    emitted = sorted_nodes.select("node", "parent", "role", "text", "idx").mapInArrow(
        emit,
        "part int, node binary, parent binary, idx int, at long, n_tokens long, ids binary, "
        "loss_from long, loss_to long",
    )
    emitted = stored(emitted, "emitted")
    sizes = emitted.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one small row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = emitted.join(bases, "part").withColumn("start", F.col("base") + F.col("at"))
    seen = _attention(members, placed.select("node", "start", "n_tokens"))
    tree = placed.join(seen, "node").select(
        "node", "parent", "idx", "start", "n_tokens", "ids", "loss_from", "loss_to", "position", "attends"
    )
    return stored(tree, "tree"), members


def _attention(members: DataFrame, starts: DataFrame) -> DataFrame:
    """(node, position, attends): positions and merged intervals, from one conversation through each node."""
    owner = members.groupBy("node").agg(F.min(F.struct("conv_id", "idx")).alias("o"))
    owner = owner.select("node", F.col("o.conv_id").alias("of"), F.col("o.idx").alias("k"))
    owned = F.col("of").eqNullSafe(F.col("conv_id")) & (F.col("k") == F.col("idx"))
    rows = members.join(owner, "node").join(starts, "node")
    rows = rows.select("conv_id", "idx", "node", "start", "n_tokens", owned.alias("owned"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        position, runs = 0, []
        for batch in batches:
            out: list[list] = [[], [], []]
            for idx, node, start, n, mine in zip(*(batch.column(k).to_pylist() for k in range(1, 6))):
                if idx == 0:
                    position, runs = 0, []
                if runs and runs[-1][1] == start:
                    runs[-1] = (runs[-1][0], start + n)
                else:
                    runs.append((start, start + n))
                if mine:
                    for column, value in zip(out, (node, position, [list(r) for r in runs])):
                        column.append(value)
                position += n
            kinds = (pa.binary(), pa.int64(), pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], names=["node", "position", "attends"]
            )

    return _in_order(rows, "idx").mapInArrow(run, "node binary, position long, attends array<array<long>>")


def read_back(tree: DataFrame, members: DataFrame, path: str | None = None) -> DataFrame:
    """Digest of every conversation, from the emitted tokens alone.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars). Fails if positions or
    attention do not agree with the tokens.
    """
    path = path or vocabulary("byte_bpe_50k.json")
    rows = members.join(tree.drop("idx"), "node").select(
        "conv_id", "idx", "ids", "loss_from", "loss_to", "start", "position", "attends"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = plain_tokenizer(path)
        now, held, done = (), None, []

        def finish() -> None:
            if held is not None:
                n, told, loss_chars, loss, chars = held[:5]
                done.append((now[0], n, told.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def flush() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            columns = [pa.array([r[k] for r in done], kinds[k]) for k in range(6)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in (b.slice(low, TOGETHER) for b in batches for low in range(0, b.num_rows, TOGETHER)):
            columns = [batch.column(k).to_pylist() for k in range(8)]
            ids = [np.frombuffer(x, "<u2").tolist() for x in columns[2]]
            cut = [(i[:a], i[a:b], i[b:]) for i, a, b in zip(ids, columns[3], columns[4])]
            flat = tokenizer.decode_batch([x for c in cut for x in c], skip_special_tokens=False)
            for k, (conv_id, start, position, attends) in enumerate(
                zip(columns[0], columns[5], columns[6], columns[7])
            ):
                if (conv_id,) != now:
                    finish()
                    now, held = (conv_id,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                seen = sum(b - a for a, b in attends)
                if position != held[5] or seen != position + len(ids[k]) or attends[-1][1] != start + len(ids[k]):
                    raise ValueError("positions or attention do not agree with the tokens")
                before, learned, after = flat[3 * k : 3 * k + 3]
                role, text = parse_turn(before + learned + after)
                held[0] += 1
                held[1].update(f"{role}\n{text}\n".encode())
                held[2] += len(unescape(learned))
                held[3].update(unescape(learned).encode())
                held[4] += len(before) + len(learned) + len(after)
                held[5] += len(ids[k])
            if done:
                yield flush()
        finish()
        yield flush()

    return _in_order(rows, "idx").mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )
