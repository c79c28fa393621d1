"""Reply trees to training conversations: paths by iterative self-joins, ranked, formatted.

A message answers the message ``parent_id`` of its conversation. Self-joins by doubling give, for
every message, its ancestors 1, 2, 4, ... steps up with the score and length of the way there, so
a tree of depth d takes log2(d) joins on ids alone. A message that nothing answers ends a
branch. Branches are ranked by the mean score of their messages; the chosen ones are walked back
to the root with the same jumps, joined with their texts once, and formatted.

A conversation becomes one string, so one conversation must fit in a task; nothing else is
gathered.

Template: ``<s>``, then per turn ``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a
line break. Texts and roles are escaped so that no control string of this or of other common
templates is left in them: a backslash goes after the first character of each, backslashes are
doubled (in roles, line breaks become ``\\n`` too). Dropping one backslash of each escape gives the
text back. The loss mask holds the span of each assistant text, in code points.

Edge cases: a null text or role is empty. A null score counts 0. A ``parent_id`` that is null,
absent or not smaller than the message's own id starts a new root, so there are no cycles. Of rows
with equal conversation and message id, or with a null message id, each is kept as a message of
its own by ``from_turns``; ``paths`` expects unique ids. A null ``conv_id`` is a conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalstrata.sources.staging import stage

START, TURN, END = "<s>", "<|im_start|>", "<|im_end|>"
# Strings that common chat templates treat as control tokens, by their openings.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(TURN) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def _unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def format_turns(turns: list[tuple[str, str]], learn_from: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the texts to learn from."""
    out, at, mask = [START], len(START), []
    for role, text in turns:
        head, body = f"{TURN}{_escape_role(role)}\n", escape(text)
        if role == learn_from:
            mask.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), mask


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns that ``format_turns`` was given."""
    return [(_unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted, len(START))]


def from_turns(conversations: DataFrame) -> DataFrame:
    """Messages of conversations whose rows follow each other by ``turn``: each answers the one before.

    Equal turns are ordered by role and text; a null turn comes first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        F.col("conv_id").cast("bigint"),
        F.row_number().over(order).cast("bigint").alias("message_id"),
        "role",
        "text",
    ).select(
        "*",
        F.when(F.col("message_id") > 1, F.col("message_id") - 1).alias("parent_id"),
        F.lit(0.0).alias("score"),
    )


def _same(a: str, b: str):
    return F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))


def paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``conv_id, leaf_id, branch_rank, message_id`` of every message on each chosen branch.

    The ``branches`` best branches of each conversation: by mean score, then more messages, then
    smaller leaf id.
    """
    own = messages.select("conv_id", "message_id", "parent_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = own.select("conv_id", F.col("message_id").alias("parent_id")).alias("k")
    linked = own.where("parent_id < message_id").alias("o").join(
        known, _same("o", "k") & (F.col("o.parent_id") == F.col("k.parent_id")), "left_semi"
    )
    m, l = own.alias("m"), linked.select("conv_id", "message_id", F.col("parent_id").alias("up")).alias("l")
    level = m.join(l, _same("m", "l") & (F.col("m.message_id") == F.col("l.message_id")), "left").select(
        "m.conv_id", "m.message_id", "l.up", F.col("m.score").alias("total"), F.lit(1).cast("bigint").alias("length")
    )
    jumps, done = [], []
    while True:
        level = stage(level)
        done.append(level.where("up is null"))
        further = level.where("up is not null")
        if further.isEmpty():
            break
        jumps.append(further.select("conv_id", "message_id", "up"))
        # Only messages still below their root go on; whom they reach may have got there already.
        a, b = further.alias("a"), reduce(DataFrame.unionByName, done, further).alias("b")
        level = a.join(b, _same("a", "b") & (F.col("a.up") == F.col("b.message_id"))).select(
            "a.conv_id",
            "a.message_id",
            "b.up",
            (F.col("a.total") + F.col("b.total")).alias("total"),
            (F.col("a.length") + F.col("b.length")).alias("length"),
        )
    ends = reduce(DataFrame.unionByName, done).alias("e")
    if jumps:
        answered = jumps[0].select("conv_id", F.col("up").alias("message_id")).alias("p")
        ends = ends.join(answered, _same("e", "p") & (F.col("e.message_id") == F.col("p.message_id")), "left_anti")
    best = Window.partitionBy("conv_id").orderBy(
        (F.col("total") / F.col("length")).desc(), F.col("length").desc(), "message_id"
    )
    chosen = ends.select("conv_id", "message_id", "total", "length").withColumn("branch_rank", F.row_number().over(best))
    leaf = F.col("message_id").alias("leaf_id")
    walked = [stage(chosen.where(F.col("branch_rank") <= branches).select("conv_id", leaf, "branch_rank", "message_id"))]
    for jump in jumps:
        w, j = reduce(DataFrame.unionByName, walked).alias("w"), jump.alias("j")
        further = w.join(j, _same("w", "j") & (F.col("w.message_id") == F.col("j.message_id")))
        walked.append(stage(further.select("w.conv_id", "w.leaf_id", "w.branch_rank", F.col("j.up").alias("message_id"))))
    return reduce(DataFrame.unionByName, walked)


_FORMATTED = (
    "conv_id bigint, leaf_id bigint, branch_rank int, formatted string, loss_mask array<struct<start:int,end:int>>"
)


def conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One formatted conversation per chosen branch, with its loss mask."""
    p, m = paths(messages, branches).alias("p"), messages.alias("m")
    turn = F.struct(F.col("m.message_id").alias("at"), F.col("m.role").alias("role"), F.col("m.text").alias("text"))
    gathered = (
        p.join(m, _same("p", "m") & (F.col("p.message_id") == F.col("m.message_id")))
        .groupBy("p.conv_id", "p.leaf_id", "p.branch_rank")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [
                format_turns([(t["role"] or "", t["text"] or "") for t in turns])
                for turns in batch.column("turns").to_pylist()
            ]
            spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in ("conv_id", "leaf_id", "branch_rank")}
                | {
                    "formatted": pa.array([f for f, _ in done], pa.string()),
                    "loss_mask": pa.array([[{"start": a, "end": b} for a, b in mask] for _, mask in done], spans),
                }
            )

    return gathered.mapInArrow(write, _FORMATTED)


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say when read back: turns, and text under the loss mask."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, mask in zip(batch.column("formatted").to_pylist(), batch.column("loss_mask").to_pylist(), strict=True):
                turns = parse(text)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                learned = "".join(unescape(text[s["start"] : s["end"]]) for s in mask)
                rows.append((len(turns), _sha256(said), len(learned), _sha256(learned), len(text)))
            n, turns_sha, chars, loss_sha, total = map(list, zip(*rows, strict=True)) if rows else ([], [], [], [], [])
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in ("conv_id", "leaf_id")}
                | {
                    "n_turns": pa.array(n, pa.int64()),
                    "turns_sha256": pa.array(turns_sha, pa.string()),
                    "loss_chars": pa.array(chars, pa.int64()),
                    "loss_sha256": pa.array(loss_sha, pa.string()),
                    "formatted_chars": pa.array(total, pa.int64()),
                }
            )

    schema = (
        "conv_id bigint, leaf_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint"
    )
    return formatted.select("conv_id", "leaf_id", "formatted", "loss_mask").mapInArrow(read, schema)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
