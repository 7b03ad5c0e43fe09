"""Chat formatting with loss masks aligned to token offsets.

A turn is rendered as ``<turn ROLE>`` newline TEXT ``</turn>`` newline. Inside roles
and texts every backslash is doubled and the markers are broken up by a
backslash, so a rendered conversation has markers only where turns begin and
end, and dropping one level of backslashes gives the text back.

A conversation is rendered whole and encoded once with offsets. Its assistant
texts are sorted spans; binary search finds the tokens that touch them, and a
token counts for the loss where it overlaps a span. A very long conversation is
rendered in parts that end between turns, so memory stays bounded.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelmeter.llm.tokens import tokenizer_path

DEFAULT = "byte_bpe_50k.json"
#: The same vocabulary as ranks of byte strings; a third of the time, and offsets need no Python objects.
RANKS = "byte_bpe_50k.tiktoken"
#: Characters after which a part ends with the turn.
PART = 1 << 20

_CONTROL = re.compile(r"\\|<turn|</turn>")
_TURN = re.compile(r"<turn ((?:[^\\>]|\\.)*)>\n(.*?)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

FORMATTED = (
    "conv_id long, part int, last boolean, text string, ids array<int>, token_steps array<int>, "
    "token_chars array<int>, loss array<boolean>, span_starts array<int>, span_ends array<int>"
)
_DIGEST = (
    "conv_id long, part int, last boolean, n_turns long, turns string, loss string, formatted_chars long"
)


def _broken(m: re.Match) -> str:
    return "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:]


def escape(text: str | None) -> str:
    return _CONTROL.sub(_broken, text or "")


def escape_role(role: str | None) -> str:
    return escape(role).replace(">", "\\>")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str | None, str | None]], loss_role: str = "assistant") -> tuple[str, list[int], list[int]]:
    """(text, starts, ends) with the spans of the texts of ``loss_role``."""
    out, at, starts, ends = [], 0, [], []
    for role, text in turns:
        head, body = f"<turn {escape_role(role)}>\n", escape(text)
        if role == loss_role:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        out += (head, body, "</turn>\n")
        at += len(head) + len(body) + 8
    return "".join(out), starts, ends


def turns_of(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a rendered conversation."""
    return [(unescape(role), unescape(body)) for role, body in _TURN.findall(text)]


def token_mask(token_starts, token_ends, span_starts, span_ends) -> np.ndarray:
    """Whether each token overlaps a span; both are sorted, spans do not overlap."""
    a, b = np.asarray(token_starts, np.int64), np.asarray(token_ends, np.int64)
    s, e = np.asarray(span_starts, np.int64), np.asarray(span_ends, np.int64)
    if not len(s):
        return np.zeros(len(a), bool)
    k = np.searchsorted(e, a, "right")  # the first span that ends behind the token's start
    return (k < len(s)) & (b > s[np.minimum(k, len(s) - 1)])


def loss_text(text: str, token_starts, token_ends, loss, span_starts, span_ends) -> str:
    """What the mask covers, as it was before escaping.

    Tokens under the mask are clipped to their spans (a token may reach over
    the end of a turn, and several may share a character).
    """
    keep = np.flatnonzero(np.asarray(loss, bool))
    a, b = np.asarray(token_starts, np.int64)[keep], np.asarray(token_ends, np.int64)[keep]
    out = []
    for s, e in zip(np.asarray(span_starts).tolist(), np.asarray(span_ends).tolist()):
        # offsets ascend, so the tokens that overlap a span are consecutive
        i, j = np.searchsorted(b, s, "right"), np.searchsorted(a, e, "left")
        if i >= j:
            continue
        reach = np.minimum(np.maximum.accumulate(b[i:j]), e)
        start = np.maximum(a[i:j], np.concatenate([[s], reach[:-1]]))
        # stretches without a gap are taken at once
        gaps = np.flatnonzero(start[1:] > reach[:-1])
        firsts, lasts = start[np.concatenate([[0], gaps + 1])], reach[np.concatenate([gaps, [-1]])]
        out.append(unescape("".join([text[x:y] for x, y in zip(firsts.tolist(), lasts.tolist())])))
    return "".join(out)


class RankTokens:
    """Ids and character offsets by a byte-level vocabulary that is given as ranks.

    Tokens follow each other without a gap in the bytes of the text, so their
    lengths give the offsets; a token that holds a part of a character covers it.
    """

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.array(self.encoding.encode_ordinary(text), np.int32)
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        raw = np.frombuffer(text.encode(), np.uint8)
        if len(raw) == len(text):
            return ids, ends - sizes, ends
        characters = np.cumsum((raw & 0xC0) != 0x80)
        return ids, characters[ends - sizes] - 1, characters[ends - 1]


def _with_offsets(path: str, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, starts, ends) in characters; ``.tiktoken`` files are ranks, others are files of ``tokenizers``."""
    if path.endswith(".tiktoken"):
        if path not in _ranks:
            _ranks[path] = RankTokens(path)
        return _ranks[path](text)
    encoded = _tokenizer(path).encode(text, add_special_tokens=False)
    offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
    return np.array(encoded.ids, np.int32), offsets[:, 0], offsets[:, 1]


_ranks: dict[str, RankTokens] = {}
_loaded: dict[str, Tokenizer] = {}


def _tokenizer(path: str) -> Tokenizer:
    if path not in _loaded:
        _loaded[path] = Tokenizer.from_file(path)
        _loaded[path].encode_special_tokens = True  # their strings in a text are ordinary text
    return _loaded[path]


def _formatted(batches: Iterator[pa.RecordBatch], path: str, loss_role: str) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0

    def part(conv, number, last, turns):
        nonlocal held
        text, starts, ends = render(turns, loss_role)
        ids, a, b = _with_offsets(path, text)
        held += len(text)
        rows.append((conv, number, last, text, ids, np.diff(a, prepend=0), b - a, token_mask(a, b, starts, ends), starts, ends))

    def out():
        nonlocal held
        columns = list(zip(*rows))
        arrays = [pa.array(c, t) for c, t in zip(columns[:4], _ARROW.types)]
        arrays += [_lists(c, t) for c, t in zip(columns[4:], _ARROW.types[4:])]
        rows.clear()
        held = 0
        return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)

    conv, number, turns, size, begun = None, 0, [], 0, False
    for batch in batches:
        for conv_id, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text"))):
            if begun and conv_id != conv:
                part(conv, number, True, turns)
                number, turns, size = 0, [], 0
            elif size > PART:
                part(conv, number, False, turns)
                number, turns, size = number + 1, [], 0
            conv, begun = conv_id, True
            turns.append((role, text))
            size += len(text or "")
            if len(rows) >= 256 or held > PART:
                yield out()
    if begun:
        part(conv, number, True, turns)
    if rows:
        yield out()


def _lists(values, kind: pa.ListType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate([np.asarray(v) for v in values]) if ends[-1] else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(kind.value_type.to_pandas_dtype())))


def _views(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column, as parts of one array; no Python numbers are made."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    at = column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip((at[:-1] - at[0]).tolist(), (at[1:] - at[0]).tolist())]


_INTS, _FLAGS = pa.list_(pa.int32()), pa.list_(pa.bool_())
_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()), ("part", pa.int32()), ("last", pa.bool_()), ("text", pa.string()), ("ids", _INTS),
        ("token_steps", _INTS), ("token_chars", _INTS), ("loss", _FLAGS), ("span_starts", _INTS), ("span_ends", _INTS),
    ]
)


def format_conversations(
    conversations: DataFrame, tokenizer: str | None = None, loss_role: str = "assistant"
) -> DataFrame:
    """Rendered conversations (one row each, or one per part of a very long one) with ids, offsets and masks.

    Turns are ordered by ``turn`` (nulls first), equal ones by role and text.
    ``token_steps`` are the starts of the tokens, each less the one before, and
    ``token_chars`` their lengths, both in characters: small numbers, which files keep small.
    ``tokenizer`` is a file of ranks (``.tiktoken``) or of ``tokenizers`` (``.json``).
    Null texts and roles are empty; rows with a null ``conv_id`` are one
    conversation of that id. Repeated rows are repeated turns. Other columns are
    left out, an empty table gives an empty result. Rows reach a task sorted and
    pass by one after the other: no conversation is gathered whole beyond ``PART``.
    """
    path = tokenizer or tokenizer_path(RANKS)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    tasks = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(lambda b: _formatted(b, path, loss_role), FORMATTED)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        lists = [_views(batch[c]) for c in ("token_steps", "token_chars", "loss", "span_starts", "span_ends")]
        for k, (conv, part, last) in enumerate(zip(*(batch[c].to_pylist() for c in ("conv_id", "part", "last")))):
            text, (steps, chars, loss, starts, ends) = batch["text"][k].as_py(), (x[k] for x in lists)
            token_starts = np.cumsum(steps, dtype=np.int64)
            turns = turns_of(text)
            spoken = "".join(f"{role}\n{body}\n" for role, body in turns)
            lost = loss_text(text, token_starts, token_starts + chars, loss, starts, ends)
            rows.append((conv, part, last, len(turns), spoken, lost, len(text)))
        names = ["conv_id", "part", "last", "n_turns", "turns", "loss", "formatted_chars"]
        types = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        columns = list(zip(*rows)) if rows else [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation and part; digests run on over the parts of one."""
    turns = loss = None
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if turns is None:
                turns, loss, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            turns.update(r["turns"].encode())
            loss.update(r["loss"].encode())
            n, chars, size = n + r["n_turns"], chars + len(r["loss"]), size + r["formatted_chars"]
            if r["last"]:
                rows.append((r["conv_id"], n, turns.hexdigest(), chars, loss.hexdigest(), size))
                turns = None
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = list(zip(*rows)) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """Per conversation of a stored result: turns and loss texts, parsed from it, as digests.

    Conversations of one part stay where they are; only parts of longer ones are shuffled.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    parts = spark.read.schema(FORMATTED).parquet(path)
    alone = (F.col("part") == 0) & F.col("last")
    whole = parts.where(alone).mapInArrow(_parts, _DIGEST).mapInArrow(_digests, schema)
    several = parts.where(~alone).mapInArrow(_parts, _DIGEST).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return whole.unionByName(several.mapInArrow(_digests, schema))
