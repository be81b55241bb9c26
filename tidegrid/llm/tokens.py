"""Encoding of texts with a public byte-level BPE vocabulary (problem 8).

Plan of ``encode_documents``: texts travel to Python as Arrow batches; each task cuts them into the pre-tokenizer's
words with numpy, over whole batches at once, and encodes the distinct words of a slice in DuckDB: token-position rows
join the merge table, and a recursive query contracts the minimum-rank pair of each word until no pair of the word is
in the table. An ordered aggregation gathers each word's ids; ids of documents are gathered by dictionary index.

No shuffle: the operator is one narrow stage, so its cost is linear in the text and no key can be hot. A task holds one
slice of about ``slice_bytes`` of text (or one document, if that is longer) at a time.
"""

from __future__ import annotations

import functools
import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.session import add_package

#: Where the public vocabulary files lie; a parameter, as they are never copied into the repository.
TOKENIZER_DIR = os.environ.get("TIDEGRID_TOKENIZERS", "/opt/tokenizers")

# The code points of Unicode White_Space.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
SPACE, LETTER, NUMBER, OTHER, NONE = range(5)
#: Texts are cut into words in blocks of about this many bytes; a worker keeps the ids of up to KNOWN_BYTES of words.
BLOCK_BYTES, KNOWN_BYTES = 2_000_000, 24_000_000
#: Words are encoded in parts of about this many bytes (a longer word by itself).
ROUND_BYTES = 2_000_000

#: Contract the pairs of all unfinished words, one rank per word and round. The rows of `init` come ordered by
#: (wid, pos) and one thread keeps them so; unordered rows raise an error. A merge's result only occurs in merges of
#: higher rank, so contracting the leftmost pair of least rank again and again takes all disjoint occurrences of that
#: pair, from the left, before any other pair: one round does them together. `run` numbers candidates within a row of
#: overlapping ones (as in "aaaa"), of which every other is taken.
CONTRACT = """
with recursive s(wid, pos, tok, done) as (
  select wid, pos, tok, false from init
  union all
  (with p as materialized (
     select a.wid, a.pos, a.tok, g.rk, g.made
     from (select wid, pos, tok,
                  case when lead(wid) over () = wid then lead(tok) over () end as nxt,
                  case when lag(wid) over () > wid or (lag(wid) over () = wid and lag(pos) over () >= pos)
                       then error('rows out of order') end as guard
           from s where not done) a
     left join merges g on g.pair = a.tok::bigint * 65536 + a.nxt
     where a.guard is null),
   least as (select wid, min(rk) as rk from p where rk is not null group by wid),
   c as (select p.wid, p.pos, p.tok, p.made, least.rk is null as done, coalesce(p.rk = least.rk, false) as cand
         from p left join least on p.wid = least.wid),
   n as (select *, row_number() over () as rn from c),
   r as (select *, rn - coalesce(max(case when cand then null else rn end) over (rows unbounded preceding), 0) as run
         from n),
   h as (select wid, pos, tok, made, done, cand and run % 2 = 1 as hit from r)
   select wid, pos, case when hit then made else tok end, done
   from (select *, lag(hit, 1, false) over () as gone from h) where not gone))
select wid, list(tok order by pos) as ids from s where done group by wid order by wid
"""


@functools.lru_cache(maxsize=1)
def _classes():
    """Class of every code point."""
    import unicodedata

    import numpy as np

    major = {"L": LETTER, "N": NUMBER}
    table = np.array([major.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x40000)] + [OTHER] * 0xD0000, np.uint8)
    table[list(WHITE_SPACE)] = SPACE
    return table


def word_starts(data, doc_starts):
    """Byte offsets at which words begin, for texts lying end to end in data (UTF-8 as uint8) from doc_starts on.

    The words are those of the byte-level pre-tokenizer: runs of letters, of digits or of other characters, each with
    one blank before it; short endings after an apostrophe; white space, whose last character stands apart before
    anything else. Cutting a text where a word begins leaves the words of both parts as they were.
    """
    import numpy as np

    if not len(data):
        return np.zeros(0, np.int64)
    if len(data) > 2 * BLOCK_BYTES and len(doc_starts) > 1:  # whole texts, in blocks that bound the arrays below
        ends = np.append(doc_starts, len(data))
        parts, begin = [], 0
        while begin < len(doc_starts):
            end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + BLOCK_BYTES, "right")) - 1)
            low, high = ends[begin], ends[end]
            parts.append(low + word_starts(data[low:high], doc_starts[begin:end] - low))
            begin = end
        return np.concatenate(parts)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _classes()[points]
    first = np.zeros(len(at) + 1, bool)
    first[np.searchsorted(at, doc_starts)] = True
    first[-1] = True
    before = np.concatenate([[NONE], kind[:-1]]).astype(np.uint8)
    before[first[:-1]] = NONE
    after = np.concatenate([kind[1:], [NONE]]).astype(np.uint8)
    after[first[1:]] = NONE
    blank_before = np.concatenate([[False], points[:-1] == 0x20]) & (before == SPACE)
    is_space = kind == SPACE
    start = np.where(is_space, (before != SPACE) | ((after != SPACE) & (after != NONE)), (before != kind) & ~blank_before)
    quote = np.flatnonzero((points == 0x27) & start & (after == LETTER))
    if len(quote):
        one = points[quote + 1]
        two = np.where(after[quote + 1] == LETTER, points[np.minimum(quote + 2, len(points) - 1)], 0)
        o = ord
        short = np.isin(one, [o("s"), o("t"), o("m"), o("d")])
        long = ~short & (((one == o("r")) | (one == o("v"))) & (two == o("e")) | (one == o("l")) & (two == o("l")))
        start[quote[short | long] + 1] = False
        ends = np.concatenate([quote[short] + 2, quote[long] + 3])
        start[ends[ends < len(start)]] = True
    return at[start]


@functools.lru_cache(maxsize=2)
def _vocabulary(path: str):
    """(ids of the 256 bytes, merge table, which bytes follow which within any token) of a byte-level BPE file."""
    import numpy as np
    import pyarrow as pa

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    ids = model["vocab"]
    # Bytes are written as printable characters: those that are printable as themselves, the rest from U+0100 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
    byte_ids = np.array([ids[shown[b]] for b in range(256)], np.int32)
    left, right = zip(*(m if isinstance(m, list) else m.split(" ") for m in model["merges"]))
    merges = pa.table(
        {
            "pair": pa.array([ids[a] * 65536 + ids[b] for a, b in zip(left, right)], pa.int64()),
            "rk": pa.array(range(len(left)), pa.int32()),
            "made": pa.array([ids[a + b] for a, b in zip(left, right)], pa.int32()),
        }
    )
    value = {c: b for b, c in shown.items()}
    joined = np.zeros((256, 256), bool)
    for token in ids:
        part = [value[c] for c in token if c in value]
        joined[part[:-1], part[1:]] = True
    return byte_ids, merges, joined


class WordEncoder:
    """Encodes distinct words of one task in DuckDB (one thread, no spill folder)."""

    def __init__(self, path: str):
        import duckdb

        self.byte_ids, merges, self.joined = _vocabulary(path)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "800MB", "temp_directory": ""})
        self.con.register("merge_file", merges)
        self.con.execute("create table merges as select * from merge_file")

    def encode(self, words):
        """(ids, offsets) as numpy arrays: word i has ids[offsets[i]:offsets[i + 1]]."""
        import numpy as np
        import pyarrow as pa

        words = words.cast(pa.large_binary())
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        if len(words) > 1 and offsets[-1] - offsets[0] > ROUND_BYTES:  # all words, in parts that bound the recursion's tables
            cut = min(max(int(np.searchsorted(offsets, offsets[0] + ROUND_BYTES)), 1), len(words) - 1)
            parts = []
            while len(words):
                parts.append(self.encode(words.slice(0, cut)))
                words = words.slice(cut)
                left = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
                cut = max(int(np.searchsorted(left, left[0] + ROUND_BYTES)), 1)
            counts = np.concatenate([np.diff(o) for _, o in parts])
            return np.concatenate([i for i, _ in parts]), np.concatenate([[0], np.cumsum(counts)])
        data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] else np.zeros(0, np.uint8)
        # no token holds two bytes side by side that no vocabulary entry does: what lies before and after is encoded apart,
        # which keeps long unbroken words short
        new = np.zeros(len(data), bool)
        new[1:] = ~self.joined[data[:-1], data[1:]]
        heads = offsets[:-1] - offsets[0]
        new[heads[np.diff(offsets) > 0]] = True
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, len(data)))
        init = pa.table(
            {
                "wid": np.repeat(np.arange(len(begins), dtype=np.int32), sizes),
                "pos": (np.arange(len(data)) - np.repeat(begins, sizes)).astype(np.int32),
                "tok": self.byte_ids[data],
            }
        )
        self.con.register("init", init)
        out = self.con.sql(CONTRACT).to_arrow_table().combine_chunks()
        self.con.unregister("init")
        ids = out["ids"].combine_chunks() if out["ids"].num_chunks != 1 else out["ids"].chunk(0)
        counts = np.zeros(len(begins), np.int64)
        counts[out["wid"].to_numpy()] = np.diff(ids.offsets.to_numpy())
        ends = np.concatenate([[0], np.cumsum(counts)])
        return ids.flatten().to_numpy().astype(np.int32), ends[np.searchsorted(begins, offsets - offsets[0])]


class KnownWords:
    """Ids of the words met so far by this worker, so that each slice encodes only its new words. Exact at any size:
    beyond KNOWN_BYTES it forgets all and starts anew."""

    def __init__(self, encoder):
        self.encoder, self.words = encoder, None

    def encode(self, words):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.words is None or self.words.nbytes > KNOWN_BYTES:
            self.words, (self.ids, self.offsets) = words, self.encoder.encode(words)
            return self.ids, self.offsets
        place = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(place))
        if len(new):
            ids, offsets = self.encoder.encode(new)
            self.ids = np.concatenate([self.ids, ids])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + offsets[1:]])
            self.words = pa.concat_arrays([self.words, new])
        index = place.fill_null(0).to_numpy().astype(np.int64)
        index[pc.is_null(place).to_numpy(zero_copy_only=False)] = np.arange(len(self.words) - len(new), len(self.words))
        ids, counts = gather(self.ids, self.offsets, index)
        return ids, np.concatenate([[0], np.cumsum(counts)])


@functools.lru_cache(maxsize=2)
def word_encoder(path: str, kind: type):
    """One encoder a worker process, kept between its tasks."""
    return KnownWords(kind(path))


class LibraryEncoder:
    """The same vocabulary through the public library: a word at a time, for sizes and blocks (problems 9 and 10)."""

    def __init__(self, path: str):
        import base64

        import tiktoken

        with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        self.encoding = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})

    def encode(self, words):
        import numpy as np

        each = [self.encoding._encode_single_piece(w) for w in words.to_pylist()]
        offsets = np.zeros(len(each) + 1, np.int64)
        np.cumsum([len(x) for x in each], out=offsets[1:])
        ids = np.fromiter((i for x in each for i in x), np.int32, offsets[-1])
        return ids, offsets


def gather(ids, offsets, index):
    """Ids of the words index[0], index[1], ... in turn, and the number of ids of each."""
    import numpy as np

    counts = (offsets[1:] - offsets[:-1])[index]
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int32), counts
    shift = (offsets[:-1][index] - np.concatenate([[0], np.cumsum(counts)[:-1]])).astype(np.int32 if total < 2**31 > len(ids) else np.int64)
    return ids[np.repeat(shift, counts) + np.arange(total, dtype=shift.dtype)], counts


def slices(batches, column: str, slice_bytes: int):
    """Tables of about slice_bytes in a string column (at least one row each), from a stream of record batches."""
    import numpy as np
    import pyarrow as pa

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        widths = np.diff(_text_buffers(batch.column(column))[0])
        begin = 0
        while begin < batch.num_rows:
            total = size + np.cumsum(widths[begin:])
            cut = int(np.searchsorted(total, slice_bytes)) + 1
            held.append(batch.slice(begin, cut))
            size = int(total[min(cut, len(total)) - 1])
            begin += cut
            if size >= slice_bytes:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _text_buffers(texts):
    """(offsets from 0, bytes) of a string array without nulls."""
    import numpy as np
    import pyarrow as pa

    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], data


def encoded(texts, encoder):
    """For a string array: (bytes, text offsets, word starts with the end, first word of each text, ids, ids per word)."""
    import numpy as np
    import pyarrow as pa

    offsets, data = _text_buffers(texts)
    starts = word_starts(data, offsets[:-1][np.diff(offsets) > 0])
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return data, offsets, np.zeros(1, np.int64), first, np.zeros(0, np.int32), np.zeros(0, np.int64)
    bounds = np.append(starts, len(data))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    coded = words.dictionary_encode()
    ids, at = encoder.encode(coded.dictionary)
    all_ids, counts = gather(ids, at, coded.indices.to_numpy())
    return data, offsets, bounds, first, all_ids, counts


def encode_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = f"{TOKENIZER_DIR}/byte_bpe_50k.json",
    slice_bytes: int = 12_000_000,
) -> DataFrame:
    """(id_col, ids array<int>) of each document, in no particular order; special tokens' strings are ordinary text.

    Null, empty: an empty list, never null. Repeated rows and repeated ids each give a row of their own; a null id stays
    null. Other columns, whatever their names, are not read. Very long texts are encoded whole. An empty table gives
    an empty result.
    """
    add_package(docs.sparkSession)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        encoder = None
        for table in slices(batches, "text", slice_bytes):
            encoder = encoder or word_encoder(tokenizer, WordEncoder)
            _, _, _, first, ids, counts = encoded(table["text"], encoder)
            ends = np.concatenate([[0], np.cumsum(counts)])[first].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
            yield from pa.Table.from_arrays([table["id"], lists], [id_col, "ids"]).to_batches(max_chunksize=2000)

    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(run, schema)
