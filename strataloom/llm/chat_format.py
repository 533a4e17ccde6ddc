"""Chat formatting with offset-aligned loss masks.

Template, per turn in order: ``<s>`` opens and ``</s>`` closes every turn; a user's text stands
between ``[INST]`` and ``[/INST]``, a system text between ``[SYS]`` and ``[/SYS]``, an assistant's
text stands alone, any other role is named between ``[ROLE]`` and ``[/ROLE]`` before its text.

Inside texts a backslash is doubled and each control string gets a backslash after its first
character, so that no control string is left in a text and unescaping (a backslash drops, the
character after it stays) is exact.

Masks: a whole conversation is rendered, encoded once with character offsets, and each token is
under the loss where its span meets the span of an assistant text, found by binary search in the
sorted spans. The control strings are special tokens of the encoder, which no ordinary token can
straddle; so the masked characters are exactly the assistant texts. Very long runs of white space
are encoded in pieces (see ``token_rollup.pieces``); offsets go on over them.

Scale: one shuffle by conv_id with a sort inside partitions; turns stream through, a conversation
longer than ``PART_CHARS`` is emitted in several parts of whole turns (with the same tokens, since
control strings separate turns), so memory does not grow with a conversation.

Defined results: null texts and roles are empty. Turns with equal numbers are ordered by role and
text, repeated rows stay as repeated turns, a null turn sorts first; a null conv_id is one
conversation. An empty table has no conversations. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm.common import table
from strataloom.llm.token_rollup import SPLIT, pieces

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]")
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PART_CHARS = 1 << 20
_ESCAPE = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_UNESCAPE = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<s>(.*?)</s>", re.S)
PART_SCHEMA = "conv_id bigint, part int, last boolean, formatted string, input_ids array<int>, starts array<int>, ends array<int>, loss_mask array<boolean>"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def render_turn(role: str, text: str) -> tuple[str, tuple[int, int] | None]:
    """The rendered turn, and where in it the text is if it is an assistant's."""
    body = escape(text)
    if role == "assistant":
        return f"<s>{body}</s>", (3, 3 + len(body))
    if role == "user":
        return f"<s>[INST]{body}[/INST]</s>", None
    if role == "system":
        return f"<s>[SYS]{body}[/SYS]</s>", None
    return f"<s>[ROLE]{escape(role)}[/ROLE]{body}</s>", None


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn: the inverse of rendering."""
    out = []
    for m in _TURN.finditer(formatted):
        body = m[1]
        if body.startswith("[INST]"):
            out.append(("user", unescape(body[6:-7])))
        elif body.startswith("[SYS]"):
            out.append(("system", unescape(body[5:-6])))
        elif body.startswith("[ROLE]"):
            role, _, text = body[6:].partition("[/ROLE]")
            out.append((unescape(role), unescape(text)))
        else:
            out.append(("assistant", unescape(body)))
    return out


@functools.lru_cache(maxsize=4)
def load_encoder(path: str):
    """(encoder with the control strings as special tokens, bytes of each token id)."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
    first = max(ranks.values()) + 1
    special = {c: first + i for i, c in enumerate(CONTROL)}
    size = np.zeros(first + len(CONTROL), dtype=np.int64)
    for piece, rank in ranks.items():
        size[rank] = len(piece)
    for c, i in special.items():
        size[i] = len(c)
    return tiktoken.Encoding("chat", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special), size


def encode_with_offsets(text: str, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token ids, first character, end character) of each token of the whole text.

    The encoding is lossless, so byte offsets are running sums of token sizes; a token that holds a
    part of a character's bytes gets that character.
    """
    encoder, size = load_encoder(path)
    ids = np.array([i for p in pieces(text) for i in encoder.encode(p, allowed_special="all")], dtype=np.int32)
    end = np.cumsum(size[ids])
    start = end - size[ids]
    raw = text.encode("utf-8", "surrogatepass")
    if len(raw) == len(text):
        return ids, start, end
    char = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return ids, char[start] - 1, char[end - 1]


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Whether each token's [start, end) meets one of the sorted, disjoint spans."""
    if not len(spans):
        return np.zeros(len(starts), bool)
    at = np.searchsorted(spans[:, 1], starts, side="right")
    there = at < len(spans)
    return there & (spans[np.minimum(at, len(spans) - 1), 0] < ends) & (ends > starts)


def encode_part(turns: list[tuple[str, str]], tokenizer_path: str) -> dict:
    pieces, spans, at = [], [], 0
    for role, text in turns:
        piece, own = render_turn(role, text)
        if own is not None and own[1] > own[0]:
            spans.append((at + own[0], at + own[1]))
        pieces.append(piece)
        at += len(piece)
    formatted = "".join(pieces)
    ids, starts, ends = encode_with_offsets(formatted, tokenizer_path)
    mask = loss_mask(starts, ends, np.array(spans, dtype=np.int64).reshape(-1, 2))
    return {"formatted": formatted, "input_ids": ids, "starts": starts.astype(np.int32), "ends": ends.astype(np.int32), "loss_mask": mask}


def masked_text(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> Iterator[str]:
    """The characters under the mask, unescaped, each run of touching tokens as one string.

    Tokens that share a character (parts of its bytes) count it once.
    """
    s, e = starts[mask], ends[mask]
    if not len(s):
        return
    new = np.flatnonzero(np.r_[True, s[1:] > np.maximum.accumulate(e)[:-1]])
    for a, b in zip(new, np.r_[new[1:], len(s)], strict=True):
        yield unescape(formatted[s[a] : e[a:b].max()])


def _turn_rows(conversations: DataFrame) -> DataFrame:
    c = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return c.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_conversations(conversations: DataFrame, tokenizer_path: str = TOKENIZER, part_chars: int = PART_CHARS) -> DataFrame:
    """One row per conversation (or part of a very long one), parts in order within their partition."""

    def emit(done: list[dict]) -> pa.RecordBatch:
        cols = {k: [d[k] for d in done] for k in ("conv_id", "part", "last", "formatted", "input_ids", "starts", "ends", "loss_mask")}
        types = (pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.bool_()))
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols.values(), types, strict=True)], list(cols))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        conv, part, turns, chars = none, 0, [], 0
        done: list[dict] = []
        held = 0

        def close(last: bool) -> None:
            nonlocal part, turns, chars, held
            done.append({"conv_id": conv, "part": part, "last": last} | encode_part(turns, tokenizer_path))
            held += chars
            part, turns, chars = part + 1, [], 0

        for b in batches:
            for c, role, text in zip(b.column("conv_id").to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True):
                if c != conv:
                    if conv is not none:
                        close(True)
                    conv, part = c, 0
                elif chars >= part_chars:
                    close(False)
                if held >= part_chars:
                    yield emit(done)
                    done, held = [], 0
                turns.append((role, text))
                chars += len(text) + 32
        if conv is not none:
            close(True)
        if done:
            yield emit(done)

    return _turn_rows(conversations).mapInArrow(rows, PART_SCHEMA)


def digests(parts: DataFrame) -> DataFrame:
    """What the parts hold, read back from them: turns by parsing, loss text by the token mask.

    Runs in the partitions of format_conversations, where the parts of a conversation follow
    each other; hashes are updated part by part.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns_sha, loss_sha = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = formatted_chars = 0
        for b in batches:
            out = []
            lists = {k: (b.column(k).offsets.to_numpy(), b.column(k).values.to_numpy(zero_copy_only=False)) for k in ("starts", "ends", "loss_mask")}
            for i, (conv_id, last, f) in enumerate(zip(b.column("conv_id").to_pylist(), b.column("last").to_pylist(), b.column("formatted").to_pylist(), strict=True)):
                starts, ends, mask = (values[offsets[i] : offsets[i + 1]] for offsets, values in lists.values())
                formatted_chars += len(f)
                for role, text in parse(f):
                    n_turns += 1
                    turns_sha.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for x in masked_text(f, starts, ends, mask.astype(bool)):
                    loss_chars += len(x)
                    loss_sha.update(x.encode("utf-8", "surrogatepass"))
                if last:
                    out.append((conv_id, n_turns, turns_sha.hexdigest(), loss_chars, loss_sha.hexdigest(), formatted_chars))
                    turns_sha, loss_sha = hashlib.sha256(), hashlib.sha256()
                    n_turns = loss_chars = formatted_chars = 0
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return parts.mapInArrow(rows, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id bigint, turn bigint, role string, text string")
    return digests(format_conversations(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)))


# The template and tokenizer cannot run in SQL; the digests of the input can, and must be equal.
OP8_INPUT_SQL = r"""
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(coalesce(text, ''))) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(coalesce(text, ''), '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256
FROM conversations GROUP BY conv_id
"""
