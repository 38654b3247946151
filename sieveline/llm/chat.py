"""Chat formatting with loss masks aligned to token offsets."""

import hashlib
import itertools
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

START, MIDDLE, END = "<|turn|>", "\n", "<|over|>\n"
LEARNED = ("assistant",)
# Conversations encoded by one call.
CHATS = 256

FORMATTED = (
    "conv_id long, n_turns long, formatted string, loss_spans array<struct<start:int,end:int>>,"
    " tokens array<int>, offsets array<int>, token_loss array<boolean>"
)
READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escaped(text):
    """Reversible: no control string of the template is left, as each of them begins with <|."""
    return text.replace("\\", "\\\\").replace("<|", "\\<|")


def escaped_role(role):
    return escaped(role).replace("\n", "\\n")


def unescaped(text):
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL)


def render(turns):
    """The formatted conversation, and the start and end of each turn's text in it.

    `turns` are (role, text); a turn is START role MIDDLE text END.
    """
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escaped_role(role) + MIDDLE, escaped(text)
        parts += head, body, END
        spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


TURN = re.compile(r"<\|turn\|>((?:[^\\\n]|\\.)*?)\n((?:[^\\<]+|\\.|<(?!\|))*+)<\|over\|>\n", re.DOTALL)


def parsed(formatted):
    """The turns (role, text) of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        match = TURN.match(formatted, at)
        if not match:
            raise ValueError("not a formatted conversation")
        turns.append((unescaped(match[1]), unescaped(match[2])))
        at = match.end()
    return turns


def overlaps(offsets, spans):
    """The parts of tokens in spans: (token, start, end) arrays.

    `offsets` (n, 2) and `spans` (m, 2) are sorted; spans don't overlap each
    other. The spans that a token touches are found by binary search.
    """
    offsets, spans = np.asarray(offsets, np.int64).reshape(-1, 2), np.asarray(spans, np.int64).reshape(-1, 2)
    spans = spans[spans[:, 0] < spans[:, 1]]
    first = np.searchsorted(spans[:, 1], offsets[:, 0], "right")
    last = np.searchsorted(spans[:, 0], offsets[:, 1], "left")
    counts = np.maximum(last - first, 0)
    token = np.repeat(np.arange(len(offsets)), counts)
    at = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return token, np.maximum(offsets[token, 0], spans[at, 0]), np.minimum(offsets[token, 1], spans[at, 1])


def covered(starts, ends):
    """Union of sorted intervals as (start, end) pairs; touching ones are joined."""
    found = []
    for start, end in zip(starts, ends):
        if found and start <= found[-1][1]:
            found[-1][1] = max(found[-1][1], end)
        else:
            found.append([start, end])
    return found


def whole_conversations(turns):
    """(conv_id, turns): one row per conversation, its turns sorted by turn, null last, then role and text.

    Null roles and texts are empty. Rows of a null conv_id are one conversation.
    A conversation is one value of the result, so its rows come together.
    """
    columns = {"conv_id": "long", "turn": "long", "role": "string", "text": "string"}
    rows = turns.select(*(turns[name].cast(kind).alias(name) for name, kind in columns.items()))
    turn = F.struct(
        F.col("turn").isNull(), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def format_chats(turns, vocabulary, learned=LEARNED):
    """One row per conversation of `turns` (conv_id, turn, role, text), FORMATTED.

    Each conversation is rendered whole and encoded once; `offsets` are the
    start and end of each token in code points, one after the other.
    `loss_spans` are the texts of the roles in `learned`; `token_loss` marks the
    tokens that have a character in one. `vocabulary` is a tokenizer file's JSON.

    Texts that hold control strings are escaped and read back as they were, see
    read_back(). An empty table gives no rows, repeated rows are repeated turns.
    """
    # Control strings of the vocabulary in a text are text, like all else.
    own = json.loads(vocabulary)
    own["added_tokens"] = []
    sent = turns.sparkSession.sparkContext.broadcast(json.dumps(own))
    names = ["conv_id", "n_turns", "formatted", "loss_spans", "tokens", "offsets", "token_loss"]

    def run(batches):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(sent.value)
        for batch in batches:
            conversations = batch.column(1)
            said = conversations.flatten()
            roles, texts = said.field(0).to_pylist(), said.field(1).to_pylist()
            ends = np.concatenate([[0], np.cumsum(conversations.value_lengths().to_numpy())])
            counts = np.diff(ends)
            for start in range(0, len(batch), CHATS):
                part = range(start, min(start + CHATS, len(batch)))
                told = [list(zip(roles[ends[n] : ends[n + 1]], texts[ends[n] : ends[n + 1]])) for n in part]
                rendered = [render(turns) for turns in told]
                loss = [[place for (role, _), place in zip(turns, spans) if role in learned] for turns, (_, spans) in zip(told, rendered)]
                encoded = tokenizer.encode_batch([text for text, _ in rendered], add_special_tokens=False)
                offsets = [_flat(one.offsets, 2 * len(one)) for one in encoded]
                masks = []
                for one, spans in zip(offsets, loss):
                    masks.append(np.zeros(len(one) // 2, bool))
                    masks[-1][overlaps(one, spans)[0]] = True
                spans = pa.StructArray.from_arrays(
                    [pa.array([place[n] for spans in loss for place in spans], pa.int32()) for n in range(2)], ["start", "end"]
                )
                ids = [np.array(one.ids, np.int32) for one in encoded]
                columns = [batch.column(0).slice(start, len(part)), pa.array(counts[start : start + len(part)], pa.int64())]
                columns += [pa.array([text for text, _ in rendered], pa.string()), pa.ListArray.from_arrays(_ends(loss), spans)]
                columns += [pa.ListArray.from_arrays(_ends(arrays), pa.array(np.concatenate(arrays))) for arrays in (ids, offsets, masks)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return whole_conversations(turns).mapInArrow(run, FORMATTED)


def read_back(formatted):
    """READ per row of format_chats(): what the formatted text, the tokens and their loss mask say.

    The turns are parsed from the text. The text under the loss mask is put
    together from the parts of masked tokens in loss spans, and unescaped.
    """

    def run(batches):
        for batch in batches:
            rows, texts = [], batch.column(1).to_pylist()
            spans, offsets, marked = (batch.column(n) for n in (2, 3, 4))
            places = np.stack([spans.flatten().field(n).to_numpy() for n in range(2)], axis=1)
            all_offsets = offsets.flatten().to_numpy().reshape(-1, 2)
            mask = marked.flatten().to_numpy(zero_copy_only=False)
            span_at, token_at = (np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())]) for column in (spans, marked))
            for n, text in enumerate(texts):
                told, tokens = parsed(text), slice(token_at[n], token_at[n + 1])
                _, starts, ends = overlaps(all_offsets[tokens][mask[tokens]], places[span_at[n] : span_at[n + 1]])
                # Parts of two texts never touch, the template stands between them.
                loss = "".join(unescaped(text[start:end]) for start, end in covered(starts.tolist(), ends.tolist()))
                said = "".join(f"{role}\n{body}\n" for role, body in told)
                rows.append((len(told), _sha(said), len(loss), _sha(loss), len(text)))
            names = [part.split()[0] for part in READ.split(", ")]
            kinds = [pa.string() if "sha" in name else pa.int64() for name in names[1:]]
            columns = [pa.array([row[n] for row in rows], kind) for n, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    # The tokens themselves are not read.
    formatted = formatted.select("conv_id", "formatted", "loss_spans", "offsets", "token_loss")
    return formatted.mapInArrow(run, READ)


def _flat(pairs, n):
    return np.fromiter(itertools.chain.from_iterable(pairs), np.int32, n)


def _ends(lists):
    """Offsets of an Arrow list array of these lists."""
    return pa.array(np.concatenate([[0], np.cumsum([len(one) for one in lists])]).astype(np.int32))


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
