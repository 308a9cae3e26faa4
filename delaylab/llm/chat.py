"""Chat formatting as prefix trees.

A conversation is a path of turns; conversations with the same first turns share the nodes of
those turns. Each node is named by a digest of all turns down to it, so ordering conversations by
the list of their nodes' names is the depth-first order of all trees: a distributed range sort.
One pass over the sorted rows then emits each node when it is first met, into packs of bounded
size, one tree after another. Tokens keep the position they have in their conversation and see, besides the tokens before
them in their own node, the intervals of their ancestors in the pack.

A tree larger than a pack, and one that crosses the border of two sort partitions, goes on in the
next pack, where the ancestors of the current turn are emitted again.
"""

from __future__ import annotations

import re
from base64 import b64decode
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how this vocabulary's texts are split before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Control strings of this template, then those of other common ones.
BEGIN, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = [BEGIN, SEP, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]"]
_BODY = "|".join(re.escape(c[1:]) for c in CONTROL)
_PLAIN = re.compile(rf"([<\[])(\\*)(?={_BODY})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)(?={_BODY})")
NAME = 16
PACK_TOKENS = 1 << 16
PACK_CONVERSATIONS = 4096


def escape(text: str) -> str:
    """A backslash more between the first character of a control string and the rest, so that no
    control string is left."""
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


class Codec:
    """Token ids of turns; control strings are single ids beyond the vocabulary."""

    def __init__(self, path: str):
        from tiktoken import Encoding

        with open(path, "rb") as lines:
            ranks = {b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        first = max(ranks.values()) + 1
        self.begin, self.sep, self.end = first, first + 1, first + 2
        self.model = Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks,
                              special_tokens={})

    def encode(self, role: str, text: str) -> tuple[list[int], int, int]:
        """Tokens of a turn, and where its text begins and ends among them."""
        head = [self.begin, *self.model.encode_ordinary(escape(role)), self.sep]
        body = self.model.encode_ordinary(escape(text))
        return [*head, *body, self.end], len(head), len(head) + len(body)

    def decode(self, tokens: list[int]) -> str:
        """The formatted text of some tokens."""
        names = {self.begin: BEGIN, self.sep: SEP, self.end: END}
        out, plain = [], []
        for t in [*tokens, None]:
            if t is None or t in names:
                out.append(self.model.decode_bytes(plain).decode("utf-8"))
                out.append(names.get(t, ""))
                plain = []
            else:
                plain.append(t)
        return "".join(out)


def conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, path, turns): turns in order, and the names of their nodes one after another."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"),
                    F.coalesce(text_col, F.lit("")).alias("text"))
    apart = F.when(F.col(id_col).isNull(), F.xxhash64(role_col, text_col))
    grouped = (rows.groupBy(F.col(id_col).alias("conv_id"), apart.alias("_apart"))
               .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
               .select("conv_id", F.transform(
                   "turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
                   .alias("turns")))
    kind = grouped.schema["conv_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            paths = []
            for turns in batch.column(1).to_pylist():
                name, path = b"", []
                for t in turns:
                    role = t["role"].encode()
                    name = blake2b(b"%b%d:%b%b" % (name, len(role), role, t["text"].encode()),
                                   digest_size=NAME).digest()
                    path.append(name)
                paths.append(b"".join(path))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(paths, type=pa.binary()), batch.column(1)],
                ["conv_id", "path", "turns"])

    return grouped.mapInArrow(run, f"conv_id {kind}, path binary, "
                                   "turns array<struct<role: string, text: string>>")


def forest(paths: DataFrame, vocabulary: str = VOCABULARY, pack_tokens: int = PACK_TOKENS,
           pack_conversations: int = PACK_CONVERSATIONS) -> DataFrame:
    """One row per conversation: its pack, the intervals [begin, end) of its turns in the pack's
    tokens (what its last turn attends to), and the nodes first met with it: begin, the position
    of the first token, the ancestors' intervals, token ids and, for assistant turns, the interval
    of tokens under the loss mask."""
    kind = paths.schema["conv_id"].dataType.simpleString()
    span = "struct<begin: int, end: int>"
    node = (f"struct<begin: int, position: int, ancestors: array<{span}>, tokens: array<int>, "
            f"loss: {span}>")
    arrow_span = pa.struct([("begin", pa.int32()), ("end", pa.int32())])
    arrow_node = pa.struct([("begin", pa.int32()), ("position", pa.int32()),
                            ("ancestors", pa.list_(arrow_span)), ("tokens", pa.list_(pa.int32())),
                            ("loss", arrow_span)])

    def run(batches):
        codec, part = Codec(vocabulary), TaskContext.get().partitionId()
        pack, filled, members = -1, 0, 0
        stack: list[tuple[bytes, int, int]] = []
        for batch in batches:
            out = []
            for path, turns in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                names = [path[i:i + NAME] for i in range(0, len(path), NAME)]
                shared = 0
                while shared < min(len(names), len(stack)) and stack[shared][0] == names[shared]:
                    shared += 1
                if pack < 0 or filled >= pack_tokens or members >= pack_conversations:
                    pack, filled, members, shared = pack + 1, 0, 0, 0
                del stack[shared:]
                nodes = []
                for name, turn in zip(names[shared:], turns[shared:]):
                    tokens, a, b = codec.encode(turn["role"], turn["text"])
                    loss = {"begin": a, "end": b} if turn["role"] == "assistant" else None
                    nodes.append({
                        "begin": filled, "position": sum(e - s for _, s, e in stack),
                        "ancestors": [{"begin": s, "end": e} for _, s, e in stack],
                        "tokens": tokens, "loss": loss})
                    stack.append((name, filled, filled + len(tokens)))
                    filled += len(tokens)
                members += 1
                out.append((f"{part:06d}-{pack:06d}",
                            [{"begin": s, "end": e} for _, s, e in stack], nodes))
            columns = list(zip(*out)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], type=pa.string()),
                 pa.array(columns[1], type=pa.list_(arrow_span)),
                 pa.array(columns[2], type=pa.list_(arrow_node))],
                ["conv_id", "pack", "intervals", "nodes"])

    ordered = (paths.repartitionByRange("path", "conv_id")
               .sortWithinPartitions("path", "conv_id"))
    return ordered.mapInArrow(run, f"conv_id {kind}, pack string, intervals array<{span}>, "
                                   f"nodes array<{node}>")


_TURN = re.compile(rf"{re.escape(BEGIN)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}", re.DOTALL)


def read_back(packs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Conversations as they stand in the packs: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, n_tokens, pack. A group is one pack, of bounded size."""
    kind = packs.schema["conv_id"].dataType.simpleString()
    loaded: list[Codec] = []  # once per task, not per pack

    def run(table: pa.Table) -> pa.Table:
        if not loaded:
            loaded.append(Codec(vocabulary))
        codec, spans, out = loaded[0], {}, []
        for nodes in table.column("nodes").to_pylist():
            for n in nodes:
                tokens, loss = n["tokens"], n["loss"]
                text = codec.decode(tokens)
                role, body = _TURN.fullmatch(text).groups()
                said = codec.decode(tokens[loss["begin"]:loss["end"]]) if loss else None
                spans[n["begin"], n["begin"] + len(tokens)] = (
                    unescape(role), unescape(body), None if said is None else unescape(said),
                    len(text), len(tokens))
        for intervals in table.column("intervals").to_pylist():
            turns = [spans[i["begin"], i["end"]] for i in intervals]
            whole = "".join(f"{t[0]}\n{t[1]}\n" for t in turns)
            loss = "".join(t[2] for t in turns if t[2] is not None)
            out.append((len(turns), sha256(whole.encode()).hexdigest(), len(loss),
                        sha256(loss.encode()).hexdigest(), sum(t[3] for t in turns),
                        sum(t[4] for t in turns)))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.table([table.column("conv_id"),
                         *[pa.array(c, type=k) for c, k in zip(zip(*out), kinds)],
                         table.column("pack")],
                        names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                               "formatted_chars", "n_tokens", "pack"])

    return packs.groupBy("pack").applyInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long, n_tokens long, pack string")


def format_chats(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text", vocabulary: str = VOCABULARY,
                 pack_tokens: int = PACK_TOKENS,
                 pack_conversations: int = PACK_CONVERSATIONS) -> DataFrame:
    """The packs of all conversations, written to the shared folder (see ``forest``).

    Turns are ordered by number, then role and text; repeated rows are repeated turns. NULL roles
    and texts are empty; NULL turn numbers come first; rows without a conversation id form one
    conversation per distinct role and text; texts may hold any control string; an empty table
    gives an empty result; other columns are not read.
    """
    made = forest(conversations(rows, id_col, turn_col, role_col, text_col), vocabulary,
                  pack_tokens, pack_conversations)
    path = scratch_path(rows.sparkSession, "chats")
    made.write.parquet(path)
    return rows.sparkSession.read.schema(made.schema).parquet(path)
