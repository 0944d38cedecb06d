"""BPE encoding and decoding through a table of distinct words.

The tokenizer's merges never cross white space and its normaliser keeps white space apart, so a text's ids
are its words' ids in order. Each distinct word is encoded once by the tokenizers library; ids are joined
back by position. Decoding joins ids to pieces.
"""

from __future__ import annotations

import hashlib
import os

from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import local_frame
from .wordtable import answered, buckets_for, rejoin, squeeze, unsqueeze, word_rows

_loaded: dict[int, object] = {}


def read_tokenizer(path: str) -> str:
    """The file's content, which goes to the tasks; its size is bounded by the vocabulary."""
    return Path(path).read_text(encoding="utf-8")


def _tokenizer(content: str):
    """The tokenizer without truncation, padding and threads of its own, once per worker."""
    key = hash(content)
    if key not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(content)
        made.no_truncation()
        made.no_padding()
        _loaded[key] = made
    return _loaded[key]


def pieces(content: str) -> list[str | None]:
    """Piece of each id."""
    made = _tokenizer(content)
    return [made.id_to_token(i) for i in range(made.get_vocab_size(with_added_tokens=True))]


def _read(answers: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a block's words, one after the other, and where each word's start."""
    sizes, ids = [], []
    for answer in answers:
        cut = int.from_bytes(answer[:4], "little")
        sizes.append(unsqueeze(answer[4:4 + cut], np.uint32))
        ids.append(unsqueeze(answer[4 + cut:], np.uint32))
    flat = np.concatenate(sizes).astype(np.int64) if sizes else np.zeros(0, np.int64)
    return np.concatenate(ids) if ids else np.zeros(0, np.uint32), np.concatenate(([0], np.cumsum(flat)))


def _pack(values: list[np.ndarray], places: list[int]) -> bytes:
    own = [values[i] for i in places]
    sizes = squeeze(np.array([len(v) for v in own], np.uint32))
    return len(sizes).to_bytes(4, "little") + sizes + squeeze(np.concatenate(own))


def _joined(docs: DataFrame, content: str, key: str, text: str, write, schema: str) -> DataFrame:
    buckets = buckets_for(docs)

    def answer(words: list[bytes]) -> list[np.ndarray]:
        made = _tokenizer(content)
        return [np.array(e.ids, np.uint32) for e in made.encode_batch(
            [w.decode() for w in words], add_special_tokens=False)]

    answers = answered(word_rows(docs, key, text, buckets), answer, _pack)
    return rejoin(docs, key, text, buckets, answers, _read, write, schema)


def encode(docs: DataFrame, content: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) per row of ``docs``; null and empty texts have no ids, repeated rows come back as often.

    ``key`` is an integer column, which may be null or repeated.
    """
    def write(values, keys, sizes, place) -> pa.RecordBatch:
        ids, starts = values
        lengths = (starts[1:] - starts[:-1])[place]
        flat = ids[np.repeat(starts[:-1][place] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())]
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(sizes)))]
        return pa.RecordBatch.from_arrays([
            pa.array(keys, pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32)))], [key, "ids"])

    return _joined(docs, content, key, text, write, f"`{key}` bigint, ids array<int>")


def decode(encoded: DataFrame, content: str, key: str = "doc_id") -> DataFrame:
    """(key, decoded) of (key, ids): ids joined to their pieces, which are joined by spaces in order.

    ``key`` must be unique here. The table of pieces has one row per id of the vocabulary.
    """
    table = local_frame(encoded.sparkSession, list(enumerate(pieces(content))), "id int, piece string")
    found = (encoded.select(key, F.posexplode("ids").alias("at", "id")).join(F.broadcast(table), "id")
             .groupBy(key).agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("all"))
             .select(key, F.array_join(F.col("all.piece"), " ").alias("decoded")))
    return encoded.select(key).join(found, key, "left").withColumn("decoded", F.coalesce("decoded", F.lit("")))


def round_trip(docs: DataFrame, content: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): digests of each text's ids and of what they decode to.

    The same join as ``encode``; ids and pieces of a block's distinct words are written out once, by
    looking up ids in the table of pieces, and each document strings them together.
    """
    def write(values, keys, sizes, place) -> pa.RecordBatch:
        ids, starts = values
        numbers, words = _texts(content, ids, starts)
        lengths = (starts[1:] - starts[:-1])[place]
        counts, shas, decoded, at = [], [], [], 0
        places = place.tolist()
        for size in sizes.tolist():
            own, n = places[at:at + size], int(lengths[at:at + size].sum())
            if not lengths[at:at + size].all():
                own = [i for i in own if starts[i + 1] > starts[i]]
            counts.append(n)
            shas.append(hashlib.sha256(" ".join([numbers[i] for i in own]).encode()).hexdigest())
            decoded.append(hashlib.sha256(" ".join([words[i] for i in own]).encode()).hexdigest())
            at += size
        return pa.RecordBatch.from_arrays([
            pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(shas, pa.string()),
            pa.array(decoded, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return _joined(docs, content, key, text, write,
                   f"`{key}` bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


_written: list = [None, None, None]


def _texts(content: str, ids: np.ndarray, starts: np.ndarray) -> tuple[list[str], list[str]]:
    """Each word's ids and pieces as text; kept while the same block's rows come."""
    if _written[0] is not ids:
        table = pieces(content)
        flat, cuts = ids.tolist(), starts.tolist()
        numbers, names = list(map(str, flat)), [table[i] for i in flat]
        _written[:] = [ids, [" ".join(numbers[a:b]) for a, b in zip(cuts, cuts[1:])],
                       [" ".join(names[a:b]) for a, b in zip(cuts, cuts[1:])]]
    return _written[1], _written[2]
