"""Splitting of oversized texts at natural boundaries (problem 10).

Each oversized text is parsed into a tree (``outline``): sections under headings, fenced code, elements between tags, bracketed
blocks, lists and their items, tables, paragraphs; these hold lines, lines hold sentences or the elements of one-line JSON, and
these hold words. What looks like a heading in fenced code is a line of it. Subtrees are sized and merged bottom-up (``pack``):
siblings, from the left, while their sum stays within the limit; a node within the limit is whole, and only an oversized one is
opened. A word too long for a piece is cut between characters. Sizes are tokens of a public vocabulary; cuts lie where words
begin, so that sizes of parts add up exactly (see ``word_starts``).

One narrow stage without a shuffle: linear in the text, nothing is collected, a task holds one slice of texts.
"""

from __future__ import annotations

import base64
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm.tokens import TOKENIZER_DIR, WHITE_SPACE, LibraryEncoder, encoded, slices, word_encoder
from tidegrid.session import add_package

# The pre-tokenizer's pattern, for sizes of texts cut inside a word.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE = "".join(map(chr, WHITE_SPACE))
#: Kinds of boundary, from the strongest: before a heading, after a blank line, before a list item, a line, a sentence or an
#: element of one-line JSON, a word, and within a word.
HEADING, BLANK_LINE, LIST_ITEM, LINE, SENTENCE, WORD, INSIDE = 6, 5, 4, 3, 2, 1, 0
START = 99
FENCE = re.compile(rb"^(`{3,}|~{3,})")
TITLE = re.compile(rb"^(#{1,6})(?:[ \t]|$)")
BULLET = re.compile(rb"^(?:[-*+]|\d{1,9}[.)])[ \t]")
TAG = re.compile(rb"^<([A-Za-z][\w:.-]*)(?:\s[^>]*)?>")
CLOSERS = {b"{": b"}", b"[": b"]", b"(": b")"}


def white_words(data, bounds):
    """Whether each word is white space."""
    import numpy as np

    starts, ends = bounds[:-1], bounds[1:] - 1
    ascii_white = np.zeros(256, bool)
    ascii_white[[9, 10, 11, 12, 13, 32]] = True
    out = ascii_white[data[starts]] & ascii_white[data[ends]]
    wide = np.flatnonzero(~out & ((data[starts] >= 0xC2) | ascii_white[data[starts]]) & ((data[ends] >= 0x80) | ascii_white[data[ends]]))
    raw = data.tobytes()
    for i in wide.tolist():
        part = raw[starts[i] : ends[i] + 1]
        out[i] = not part.decode("utf-8", "replace").lstrip(WHITE)
    return out


def outline(lines: list[bytes]) -> list[tuple[int, int]]:
    """(depth, kind) of the boundary before each line of a text that isn't blank (blank ones: depth -1).

    Depth: the number of nodes open there, sections of headings included. Tags and brackets that are never closed end with the
    section; an unclosed fence runs to the end of the text. List items nest by indent; rows of a table lie in one node.
    """
    out, sections, nodes, items = [], [], [], []  # nodes: fences, tags, brackets; items: indents of open list items
    blank, table = False, False
    for raw in lines:
        line = raw.strip()
        if not line:
            out.append((-1, 0))
            blank, table = True, False
            continue
        indent = len(raw.expandtabs(4)) - len(raw.expandtabs(4).lstrip())
        kind = BLANK_LINE if blank else LINE
        blank = False
        if nodes and nodes[-1][0] == "fence":
            out.append((len(sections) + len(nodes) + len(items), kind))
            if line.startswith(nodes[-1][1]) and not line.strip(nodes[-1][1][:1]):
                nodes.pop()
            continue
        if (title := TITLE.match(line)) and indent < 4:
            level = len(title[1])
            while sections and sections[-1] >= level:
                sections.pop()
            nodes, items, table = [], [], False
            out.append((len(sections), HEADING))
            sections.append(level)
            continue
        bullet = BULLET.match(line)
        while items and (indent < items[-1] or indent == items[-1] and (bullet or kind == LINE) or indent <= items[-1] and not bullet):
            items.pop()
        depth = len(sections) + len(nodes) + len(items)
        row = line.startswith(b"|")
        out.append((depth + 1, kind) if row and table else (depth, max(kind, LIST_ITEM) if bullet else kind))
        table = row
        if bullet:
            items.append(indent)
        if fence := FENCE.match(line):
            nodes.append(("fence", fence[1]))
        elif nodes and nodes[-1][0] == "tag" and nodes[-1][1] in line:
            nodes.pop()
        elif nodes and nodes[-1][0] == "bracket" and line.startswith(nodes[-1][1]):
            nodes.pop()
            if line[-1:] in CLOSERS:
                nodes.append(("bracket", CLOSERS[line[-1:]]))
        elif (tag := TAG.match(line)) and not tag[0].endswith(b"/>") and b"</" + tag[1] not in line:
            nodes.append(("tag", b"</" + tag[1]))
        elif line[-1:] in CLOSERS:
            nodes.append(("bracket", CLOSERS[line[-1:]]))
        if len(nodes) + len(items) > 200:  # deeper nesting than this isn't structure
            nodes, items = nodes[:100], []
    return out


def sentences(data, bounds):
    """Whether a sentence, or an element of one-line JSON, begins at each word (bounds: byte offsets of words, then the end), and
    how many brackets of its line are open there."""
    import numpy as np

    starts, ends = bounds[:-1], bounds[1:] - 1
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    is_blank = blank[data[starts]] & blank[data[ends]]
    last = data[np.maximum(starts - 1, 0)]
    found = np.isin(last, np.frombuffer(b".!?", np.uint8)) & (data[starts] == 32)
    three = starts >= 3
    for stop in ("。", "！", "？"):
        a, b, c = stop.encode()
        at = starts[three]
        found[three] |= (data[at - 3] == a) & (data[at - 2] == b) & (data[at - 1] == c)
    found &= ~is_blank
    step = np.zeros(256, np.int8)
    step[[ord("{"), ord("[")]], step[[ord("}"), ord("]")]] = 1, -1
    open_ = np.concatenate([[0], np.cumsum(step[data], dtype=np.int64)])[starts]
    newlines = np.flatnonzero(data == 10)
    line = np.searchsorted(newlines, starts)
    first = np.concatenate([[0], newlines + 1])
    first = first[np.minimum(line, len(first) - 1)]
    json_line = np.isin(data[np.minimum(first, len(data) - 1)], np.frombuffer(b"{[", np.uint8))
    at_line = np.concatenate([[0], np.cumsum(step[data], dtype=np.int64)])[np.minimum(first, len(data))]
    # after a comma, also one that shares its word with quotes or closing brackets before it ("},)
    element = json_line & (last == 44) & ~is_blank
    depth = np.where(json_line, np.clip(open_ - at_line, 0, 60), 0)
    return found & ~json_line | element, depth


def pack(sizes, keys, limit):
    """Runs of units [(from, to), ...] in order. sizes: sums before each unit, then the total; keys: strength of the boundary
    before each unit (the first one's doesn't matter).

    Equal keys part siblings of one node, lower ones its subtrees. Nodes close bottom-up: one within the limit is whole, of
    another the whole children are merged, from the left, while their sum stays within the limit.
    """

    def close(children):
        low, high = children[0][0], children[-1][1]
        if sizes[high] - sizes[low] <= limit:
            return low, high, None
        out, room = [], False  # room: the last run may grow
        for a, b, runs in children:
            if runs is not None:
                out += runs
                room = False
            elif room and sizes[b] - sizes[out[-1][0]] <= limit:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
                room = True
        return low, high, out

    open_nodes: list[tuple[int, list]] = []
    node = (0, 1, None)
    for i in range(1, len(keys)):
        key = keys[i]
        while open_nodes and open_nodes[-1][0] < key:
            node = close([*open_nodes.pop()[1], node])
        if open_nodes and open_nodes[-1][0] == key:
            open_nodes[-1][1].append(node)
        else:
            open_nodes.append((key, [node]))
        node = (i, i + 1, None)
    while open_nodes:
        node = close([*open_nodes.pop()[1], node])
    return [node[:2]] if node[2] is None else node[2]


class Splitter:
    """Pieces of the texts of one slice under one policy after the other."""

    def __init__(self, tokenizer: str):
        import tiktoken

        self.words = word_encoder(tokenizer, LibraryEncoder)
        self.runs: dict[bytes, int] = {}
        ranks_file = tokenizer.removesuffix(".json") + ".tiktoken"
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        self.full = tiktoken.Encoding("text", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def count(self, part: bytes) -> int:
        return len(self.full.encode_ordinary(part.decode("utf-8", "replace")))

    def tail(self, part: bytes, most: int) -> int:
        """Bytes of the longest end of part that lies between characters and holds at most ``most`` tokens."""
        if most <= 0:
            return 0
        ids = self.full._encode_bytes(part[-64 * (most + 1) :])
        size = sum(len(self.full.decode_single_token_bytes(i)) for i in ids[-most:])
        while size and ((part[len(part) - size] & 0xC0) == 0x80 or self.count(part[len(part) - size :]) > most):
            size -= 1
        return size

    def cut_word(self, word: bytes, limit: int):
        """Byte ranges of a word, each of at most ``limit`` tokens (or one character), cut between characters."""
        out, at = [], 0
        while at < len(word):
            window = word[at : at + 64 * limit]
            while at + len(window) < len(word) and len(window) > 1 and (word[at + len(window)] & 0xC0) == 0x80:
                window = window[:-1]
            ids = self.full._encode_bytes(window)
            size = sum(len(self.full.decode_single_token_bytes(i)) for i in ids[:limit])
            while True:
                while size > 0 and at + size < len(word) and (word[at + size] & 0xC0) == 0x80:
                    size -= 1
                if size <= 0 or self.count(word[at : at + size]) <= limit:
                    break
                size -= 1
            if size <= 0:  # one character of more tokens than the limit
                size = 1
                while at + size < len(word) and (word[at + size] & 0xC0) == 0x80:
                    size += 1
            out.append((at, at + size))
            at += size
        return out

    def slice(self, texts):
        """Word tables of a slice; ``pieces`` may then be asked for each policy."""
        import numpy as np

        data, offsets, bounds, first, _, counts = encoded(texts, self.words)
        self.data, self.raw, self.offsets, self.bounds, self.first = data, data.tobytes(), offsets, bounds, first
        self.sums = np.concatenate([[0], np.cumsum(counts)])
        self.new_sentence, self.brackets = sentences(data, bounds)
        self.newlines = np.flatnonzero(data == 10)
        # words that are the last character of a run of white space, right after the rest of it
        white = white_words(data, bounds)
        twin = np.concatenate([[False], white[1:] & white[:-1]]) if len(white) else white
        twin[first[first < len(twin)]] = False
        self.change = np.zeros(len(counts) + 1, np.int64)
        for i in np.flatnonzero(twin).tolist():
            run = self.raw[bounds[i - 1] : bounds[i + 1]]
            if run not in self.runs:
                self.runs[run] = self.count(run)
            self.change[i] = self.runs[run] - (counts[i - 1] + counts[i])
        self.points = np.searchsorted(np.flatnonzero((data & 0xC0) != 0x80), bounds)  # characters before each word
        self.trees = {}

    def tree(self, row: int):
        """Units of a text (their first words, then the end), the key of the boundary before each, and its kind."""
        import numpy as np

        if row in self.trees:
            return self.trees[row]
        a, b = int(self.first[row]), int(self.first[row + 1])
        begin, end = int(self.offsets[row]), int(self.offsets[row + 1])
        low, high = np.searchsorted(self.newlines, [begin, end])
        line_at = np.concatenate([[begin], self.newlines[low:high] + 1])
        shape = outline(self.raw[begin:end].split(b"\n"))
        full = np.array([i for i, (depth, _) in enumerate(shape) if depth >= 0], np.int64)
        depth, kind = (np.array([shape[i][k] for i in full], np.int64) for k in (0, 1))
        # a line's boundary lies before its first word that isn't white space
        text_at = line_at[full]
        width = np.array([len(x) - len(x.lstrip()) for x in (self.raw[line_at[i] : (line_at[i + 1] if i + 1 < len(line_at) else end)] for i in full)], np.int64)
        word = np.searchsorted(self.bounds[a : b + 1], text_at + width, "right") - 1 + a
        inner = a + np.flatnonzero(self.new_sentence[a:b])
        line_of = np.maximum(np.searchsorted(word, inner, "right") - 1, 0)
        inner_depth = (depth[line_of] if len(depth) else np.zeros(len(inner), np.int64)) + 1 + self.brackets[inner]
        words = np.concatenate([[a], word, inner])
        keys = np.concatenate([[0], -depth * 8 + kind, -inner_depth * 8 + SENTENCE])
        kinds = np.concatenate([[SENTENCE], kind, np.full(len(inner), SENTENCE)])
        order = np.lexsort((-keys, words))
        words, keys, kinds = words[order], keys[order], kinds[order]
        new = np.concatenate([[True], words[1:] != words[:-1]])
        self.trees[row] = np.append(words[new], b), keys[new].tolist(), kinds[new]
        return self.trees[row]

    def ends_in_white_space(self, low, high):
        """What the tokens of words low..high-1 change by where these end a text: its white space at the end is one word,
        not two."""
        import numpy as np

        return np.where(high - low >= 2, self.change[np.maximum(high - 1, 0)], 0)

    def pieces(self, limit: int, overlap: int):
        """Columns of the pieces of the slice's oversized texts: text row, number, tokens, shared tokens and characters, strength, bytes."""
        import numpy as np

        rows, low, high, special, kind_of = [], [], [], [], []
        room = limit - overlap
        total = self.sums[self.first[1:]] - self.sums[self.first[:-1]]
        for row in np.flatnonzero(total > limit).tolist():
            cuts, keys, kinds = self.tree(row)
            sums = self.sums[cuts].tolist()
            cuts_list = cuts.tolist()
            for u, v in pack(sums, keys, room):
                at_unit = int(kinds[u])
                begin, end = cuts_list[u], cuts_list[v]
                if sums[v] - sums[u] <= room:
                    rows.append(row), low.append(begin), high.append(end), special.append(None), kind_of.append(at_unit)
                    continue
                while begin < end:  # one unit too large: words, from the left
                    stop = int(np.searchsorted(self.sums, self.sums[begin] + room, "right")) - 1
                    stop = min(max(stop, begin), end)
                    if stop > begin:
                        rows.append(row), low.append(begin), high.append(stop), special.append(None), kind_of.append(at_unit)
                        begin, at_unit = stop, WORD
                        continue
                    at = int(self.bounds[begin])
                    for x, y in self.cut_word(self.raw[at : int(self.bounds[begin + 1])], room):
                        rows.append(row), low.append(begin), high.append(begin + 1), special.append((at + x, at + y)), kind_of.append(at_unit if not x else INSIDE)
                    begin, at_unit = begin + 1, WORD
        rows, low, high = (np.array(x, np.int64) for x in (rows, low, high))
        if not len(rows):
            return rows, rows, rows, rows, rows, rows, []
        new = np.concatenate([[True], rows[1:] != rows[:-1]])
        number = np.arange(len(rows)) - np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
        back = np.searchsorted(self.sums, self.sums[low] - overlap, "left")
        back = np.where(new, low, np.minimum(np.maximum(back, np.concatenate([[0], low[:-1]])), low))
        shared = self.sums[low] - self.sums[back]
        tokens = self.sums[high] - self.sums[back]
        tokens += self.ends_in_white_space(back, high)
        while (over := (tokens > limit) & (back < low)).any():  # should the white space at the end weigh more as one word
            back[over] += 1
            shared = self.sums[low] - self.sums[back]
            tokens = self.sums[high] - self.sums[back] + self.ends_in_white_space(back, high)
        shared = shared + self.ends_in_white_space(back, low)
        lent = self.points[low] - self.points[back]
        strength = np.where(number == 0, START, np.array(kind_of, np.int64))
        texts = [self.raw[x:y] for x, y in zip(self.bounds[back].tolist(), self.bounds[high].tolist())]
        for i in [i for i in range(len(rows)) if special[i] or (i and not new[i] and special[i - 1])]:
            begin, end = special[i] or (int(self.bounds[low[i]]), int(self.bounds[high[i]]))
            held = 0
            if not new[i]:
                prior = special[i - 1] or (int(self.bounds[low[i - 1]]), int(self.bounds[high[i - 1]]))
                before = self.raw[prior[0] : prior[1]]
                most = overlap
                held = self.tail(before, most)
                while held and self.count(before[len(before) - held :] + self.raw[begin:end]) > limit:
                    most -= 1
                    held = self.tail(before, most)
                shared[i] = self.count(before[len(before) - held :]) if held else 0
                lent[i] = len(before[len(before) - held :].decode("utf-8", "replace")) if held else 0
            texts[i] = self.raw[begin - held : end]
            tokens[i] = self.count(texts[i])
        return rows, number, tokens, shared, lent, strength, texts


def split_documents(
    docs: DataFrame,
    policies: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = f"{TOKENIZER_DIR}/byte_bpe_50k.json",
    slice_bytes: int = 8_000_000,
) -> DataFrame:
    """Pieces of each text that is longer than a policy's max_tokens.

    Columns: policy_name, id_col, piece_no (from 0), n_tokens (at most max_tokens), overlap_tokens and
    overlap_chars (the beginning shared with the piece before), boundary (kind of the boundary before the piece's own part: 6 a heading, 5 a blank line, 4 a
    list item, 3 a line, 2 a sentence or an element, 1 a word, 0 within a word; 99 at the text's start), text.
    Without their first overlap_chars characters the pieces of a text join to exactly that text. The shared part is the longest row of
    whole words at the end of the piece before that has at most overlap_tokens tokens; next to a cut within a word it may
    begin within a word. A single character of more tokens than the limit allows stays whole.
    Null, empty and short texts have no pieces. Repeated rows each give their pieces. A policy without a positive
    max_tokens has no pieces; a null or negative overlap counts as 0, one of max_tokens or more as half of max_tokens.
    Policies are settings: more than 1,000 rows are refused.
    """
    spark = docs.sparkSession
    add_package(spark)
    rules = policies.select("policy_name", "max_tokens", "overlap_tokens").limit(1001).collect()
    if len(rules) > 1000:
        raise ValueError("more than 1,000 policies")
    rules = [
        (r.policy_name, r.max_tokens, o if (o := max(r.overlap_tokens or 0, 0)) < r.max_tokens else r.max_tokens // 2)
        for r in rules
        if r.max_tokens and r.max_tokens > 0
    ]
    schema = T.StructType(
        [
            T.StructField("policy_name", T.StringType()),
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("piece_no", T.IntegerType()),
            T.StructField("n_tokens", T.IntegerType()),
            T.StructField("overlap_tokens", T.IntegerType()),
            T.StructField("overlap_chars", T.IntegerType()),
            T.StructField("boundary", T.IntegerType()),
            T.StructField("text", T.StringType()),
        ]
    )

    def run(batches):
        import pyarrow as pa

        splitter = None
        for table in slices(batches, "text", slice_bytes):
            splitter = splitter or Splitter(tokenizer)
            splitter.slice(table["text"])
            for name, limit, overlap in rules:
                rows, *numbers, texts = splitter.pieces(limit, overlap)
                if len(rows):
                    columns = [pa.array(x.astype("int32")) for x in numbers]
                    text = pa.array(texts, pa.binary()).cast(pa.string())
                    name_column = pa.array([name] * len(rows), pa.string())
                    out = pa.Table.from_arrays([name_column, table["id"].take(pa.array(rows)), *columns, text], schema.names)
                    yield from out.to_batches(max_chunksize=5000)

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length("text") > 0)
    return texts.mapInArrow(run, schema)
