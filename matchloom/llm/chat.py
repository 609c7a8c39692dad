"""Chat formatting as prefix trees: initial turns that conversations share are emitted once.

Conversations are range-partitioned and sorted by the running hashes of their turns, so those that share
initial turns are neighbours, and a first turn (or a whole conversation) that very many share is still
split over tasks. A task streams through its sorted conversations and merges each with the tree of those
before it, comparing the turns themselves, not hashes. A tree is written depth-first as one sequence of
about ``MOST_CHARS`` code points; the next sequence repeats the turns that lead to its own part.

A sequence has its text (positions are code points), its nodes in depth-first order and its
conversations. A node is one turn: its stretch of the text, its parent, the position id of its first code
point (as if its ancestors stood directly before it), the stretches it may attend to besides itself (its
ancestors', adjacent ones joined) and the stretch under the loss mask. A conversation is its last node.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash is put before the bar of
``<|``, and one more where backslashes already stand between; taking one away restores the text.
"""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import map_batches

START, END, TRAINED, MOST_CHARS = "<|im_start|>", "<|im_end|>", "assistant", 65_536
ESCAPE, UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    return ESCAPE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S))


def formatted(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its text starts and ends there."""
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parsed(turn: str) -> tuple[str, str]:
    """The role and text of a turn in the template."""
    role, _, rest = turn[len(START) :].partition("\n")
    return unescape_role(role), unescape(rest[: -len(END) - 1])


class Tree:
    """The sequence that is being written."""

    def __init__(self):
        self.parts: list[str] = []
        self.length = 0
        self.nodes: list[dict] = []
        self.conversations: list[dict] = []
        self.path: list[tuple[tuple[str, str], int]] = []  # turns and nodes of the last conversation

    def shared(self, turns: list[tuple[str, str]]) -> int:
        n = 0
        for (turn, _), own in zip(self.path, turns, strict=False):
            if turn != own:
                break
            n += 1
        return n

    def add(self, conv_id: int | None, turns: list[tuple[str, str]]) -> None:
        del self.path[self.shared(turns) :]
        for turn in turns[len(self.path) :]:
            text, a, b = formatted(*turn)
            parent = self.path[-1][1] if self.path else -1
            up = self.nodes[parent] if self.path else {"start": 0, "end": 0, "position": 0, "attention": []}
            sees = [*up["attention"]]
            if self.path:
                if sees and sees[-1]["end"] == up["start"]:
                    sees[-1] = {"start": sees[-1]["start"], "end": up["end"]}
                else:
                    sees.append({"start": up["start"], "end": up["end"]})
            learn = [self.length + a, self.length + b] if turn[0] == TRAINED else [None, None]
            node = {"parent": parent, "start": self.length, "end": self.length + len(text), "position": up["position"] + up["end"] - up["start"], "loss_start": learn[0], "loss_end": learn[1], "attention": sees}
            self.path.append((turn, len(self.nodes)))
            self.nodes.append(node)
            self.parts.append(text)
            self.length += len(text)
        self.conversations.append({"conv_id": conv_id, "node": self.path[-1][1]})

    def row(self) -> tuple[str, list[dict], list[dict]]:
        return "".join(self.parts), self.nodes, self.conversations


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
NODES = pa.list_(pa.struct([*((n, pa.int64()) for n in ("parent", "start", "end", "position", "loss_start", "loss_end")), ("attention", pa.list_(SPAN))]))
CONVERSATIONS = pa.list_(pa.struct([("conv_id", pa.int64()), ("node", pa.int64())]))
SEQUENCE = (
    "text string, nodes array<struct<parent:long,start:long,end:long,position:long,loss_start:long,loss_end:long,attention:array<struct<start:long,end:long>>>>, "
    "conversations array<struct<conv_id:long,node:long>>"
)


def sequences(df: DataFrame, most_chars: int = MOST_CHARS) -> DataFrame:
    """Prefix-tree sequences (text, nodes, conversations) of ``df`` (conv_id, turn, role, text; a row for each turn).

    Turns stand in order of turn, then role and text where turns tie; repeated rows are turns of their own.
    Null roles and texts count as empty; rows without a conv_id form one conversation. A conversation
    is never cut, however long, and memory holds one sequence and one conversation at a time. An empty
    table gives no sequence; other columns are ignored.
    """
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    talks = df.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    chain = F.aggregate("turns", F.array().cast("array<long>"), lambda a, t: F.concat(a, F.array(F.xxhash64(F.coalesce(F.get(a, F.size(a) - 1), F.lit(0).cast("long")), t["role"], t["text"]))))
    ordered = talks.withColumn("path", chain).repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree()

        def out():
            text, nodes, conversations = tree.row()
            return pa.record_batch([pa.array([text]), pa.array([nodes], NODES), pa.array([conversations], CONVERSATIONS)], ["text", "nodes", "conversations"])

        for batch in batches:
            for i in range(batch.num_rows):
                turns = [(t["role"], t["text"]) for t in batch.column(1)[i].as_py()]
                if tree.conversations:
                    more = sum(len(r) + len(t) for r, t in turns[tree.shared(turns) :])
                    if tree.length + more > most_chars or len(tree.conversations) * 16 > most_chars:
                        yield out()
                        tree = Tree()
                tree.add(batch.column(0)[i].as_py(), turns)
        if tree.conversations:
            yield out()

    return map_batches(ordered.select("conv_id", "turns"), run, SEQUENCE)


def read_back(df: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of every conversation in ``sequences``."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def one(text: str, nodes: list[dict], leaf: int) -> list:
        path = []
        while leaf >= 0:
            path.append(nodes[leaf])
            leaf = nodes[leaf]["parent"]
        turns, loss, n_loss, chars = hashlib.sha256(), hashlib.sha256(), 0, 0
        for node in reversed(path):
            role, said = parsed(text[node["start"] : node["end"]])
            turns.update(f"{role}\n{said}\n".encode())
            chars += node["end"] - node["start"]
            if node["loss_start"] is not None:
                learned = unescape(text[node["loss_start"] : node["loss_end"]])
                loss.update(learned.encode())
                n_loss += len(learned)
        return [len(path), turns.hexdigest(), n_loss, loss.hexdigest(), chars]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text, nodes, found = (batch.column(k)[i].as_py() for k in range(3))
                known: dict[int, list] = {}
                rows = [[c["conv_id"], *(known.get(c["node"]) or known.setdefault(c["node"], one(text, nodes, c["node"])))] for c in found]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return map_batches(df.select("text", "nodes", "conversations"), run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
