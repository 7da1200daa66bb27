"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch are concatenated and indexed by a suffix array (sorted as far as the longest piece
reaches). Every piece is binary-searched for the range of suffixes that begin with it; the ranges give the lattice's
edges, which are sorted by position and relaxed from left to right. The vocabulary is a BPE model, for which
the best path is not a sum of scores: an edge may follow the last piece of the best path before it only if the two
pieces could stand side by side in a BPE result, which the merge ranks decide. There is exactly one such
edge into every position, so one pass gives the library's own result. Characters without a piece become byte pieces.

Words are cut before each U+2581 (space), around line feeds and before a punctuation mark behind a letter, wherever
no piece of the model reaches across but pure runs of U+2581. Runs have pieces of equal rank; they are merged
leftmost first.

Defined results: a null text has null ids, null count and null round trip; an empty text has no ids; the round trip
is false for texts that hold U+2581 itself, which decodes to a space; rows that repeat are encoded one by
one; an empty table gives an empty result; extra columns are kept only if named.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructType

from .common import table, text_batches

SPACE = "▁"
BATCH_CHARS, BATCH_ROWS = 1 << 20, 1000
LEARN_WORDS = 20_000  # words that are indexed together
MAX_CACHED_WORDS, MAX_CACHED_CHARS = 100_000, 1 << 21
UNKNOWN = -1
MARKS = ".,;:!?"
#: Characters that may stand between units while a text is cut; one that the texts don't hold is taken.
SEPARATORS = "\ufffe\uffff\ufdd0\ufdd1\ufdd2"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces by rank: single characters first, then merges in the order in which BPE applies them."""

    def __init__(self, model: bytes):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = library.get_piece_size()
        self.byte_ids = np.full(256, library.unk_id(), np.int32)
        known: list[tuple[float, int, str]] = []
        self.runs: dict[int, int] = {}
        #: The bytes that each id decodes to.
        self.decoded = [b""] * n
        for i in range(n):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
                self.decoded[i] = bytes([int(piece[3:-1], 16)])
            elif not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i)):
                self.decoded[i] = piece.replace(SPACE, " ").encode()
                if set(piece) == {SPACE}:
                    self.runs[len(piece)] = i
                if len(piece) == 1 or SPACE not in piece[1:]:
                    known.append((library.get_score(i), i, piece))
        known.sort(key=lambda x: (len(x[2]) > 1, -x[0], x[1]))
        self.pieces = [x[2] for x in known]
        self.ids = np.array([x[1] for x in known], np.int32)
        self.rank = {p: r for r, p in enumerate(self.pieces)}
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.longest = int(self.lengths.max())
        inner = {p[k : k + 2] for p in self.pieces for k in range(len(p) - 1)}
        letters = [p for p in self.pieces if len(p) == 1 and p.isalpha()]
        marks = [c for c in MARKS if c in self.rank]
        safe = "".join(x for x in letters if not any(x + c in inner for c in marks))
        #: A mark behind a letter with which it stands together in no piece.
        self.cut = re.compile(f"[{re.escape(''.join(marks))}](?<=[{re.escape(safe)}].)", re.S) if marks and safe else None
        self.cut_lines = "\n" not in self.rank
        left, right, merged, self.left, self.right = [], [], [], np.arange(len(known)), np.arange(len(known))
        for r, p in enumerate(self.pieces):
            pairs = [(self.rank[p[:k]], self.rank[p[k:]]) for k in range(1, len(p)) if p[:k] in self.rank and p[k:] in self.rank]
            for a, b in pairs:
                left.append(a)
                right.append(b)
                merged.append(r)
            if pairs:
                self.left[r], self.right[r] = self.last_merge(p, pairs)
        keys = np.array(left, np.int64) * len(known) + np.array(right, np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(merged, np.int64)[order]

    def last_merge(self, piece: str, pairs: list[tuple[int, int]]) -> tuple[int, int]:
        """The two parts that BPE joins last when it builds the piece."""
        if len(pairs) == 1:
            return pairs[0]
        parts = list(piece)
        while len(parts) > 2:
            ranks = [self.rank.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:], strict=False)]
            i = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[i] == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return (self.rank[parts[0]], self.rank[parts[1]]) if len(parts) == 2 else pairs[0]

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether BPE leaves the pieces of each pair side by side."""
        n = len(self.pieces)
        keys, back = np.unique(first * n + second, return_inverse=True)
        a, b = keys // n, keys % n
        result = np.ones(len(keys), bool)
        limit = np.full(len(keys), 1 << 60)
        live = np.arange(len(keys))
        while len(live):
            x, y, most = a[live], b[live], limit[live]
            at = np.minimum(np.searchsorted(self.pair_keys, x * n + y), len(self.pair_keys) - 1)
            clash = (self.pair_keys[at] == x * n + y) & (self.pair_ranks[at] < most)
            result[live[clash]] = False
            live, x, y = live[~clash], x[~clash], y[~clash]
            # Undo the later of the two merges; if that one is a character, the other.
            cut_left = np.where(self.right[x] == x, False, (x > y) | (self.left[y] == y))
            cut_right = ~cut_left & (self.left[y] != y)
            limit[live] = np.where(cut_left, x, y + 1)
            a[live], b[live] = np.where(cut_left, self.right[x], x), np.where(cut_right, self.left[y], y)
            live = live[cut_left | cut_right]
        return result[back]

    @functools.lru_cache(maxsize=4096)  # noqa: B019
    def encode_run(self, n: int) -> tuple[int, ...]:
        """Ids of n spaces in a row; all merges have the same rank, so the leftmost pair goes first."""
        size, following, before = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(i, 1, 1) for i in range(n - 1) if 2 in self.runs]
        while heap:
            i, a, b = heapq.heappop(heap)
            j = following[i]
            if size[i] != a or j >= n or size[j] != b:
                continue
            size[i], size[j] = a + b, 0
            following[i] = following[j]
            if following[i] < n:
                before[following[i]] = i
                if size[i] + size[following[i]] in self.runs:
                    heapq.heappush(heap, (i, size[i], size[following[i]]))
            if before[i] >= 0 and size[before[i]] + size[i] in self.runs:
                heapq.heappush(heap, (before[i], size[before[i]], size[i]))
        return tuple(self.runs[s] for s in size if s)


def suffix_keys(codes: np.ndarray, bits: int, longest: int) -> list[np.ndarray]:
    """The first `longest` codes from every position, packed into as many 63-bit keys as they need."""
    per, n = 63 // bits, len(codes)
    padded = np.concatenate((codes, np.zeros(longest + per, np.int64)))
    keys = []
    for start in range(0, longest, per):
        key = np.zeros(n, np.int64)
        for k in range(start, start + per):
            key = (key << bits) | (padded[k : k + n] if k < longest else 0)
        keys.append(key)
    return keys


def bisect(sorted_keys: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
    """Insertion points of rows of keys among sorted rows of keys."""
    low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(sorted_keys[0]))
    while (open_ := low < high).any():
        mid = np.minimum((low + high) // 2, len(sorted_keys[0]) - 1)
        less, equal = np.zeros(len(mid), bool), np.ones(len(mid), bool)
        for key, want in zip(sorted_keys, wanted, strict=True):
            less |= equal & (key[mid] < want)
            equal &= key[mid] == want
        less = (less | equal if after else less) & open_
        low, high = np.where(less, mid + 1, low), np.where(open_ & ~less, mid, high)
    return low


class Encoder:
    """Encodes batches; words already met are kept, within a bound."""

    def __init__(self, model: bytes):
        self.vocabulary = Vocabulary(model)
        self.piece_codes = [np.frombuffer(p.encode("utf-32-le"), np.uint32).astype(np.int64) for p in self.vocabulary.pieces]
        self.byte_pool = np.frombuffer(b"".join(self.vocabulary.decoded), np.uint8)
        self.byte_len = np.array([len(x) for x in self.vocabulary.decoded], np.int64)
        self.byte_at = np.cumsum(self.byte_len) - self.byte_len
        piece_sizes = self.vocabulary.lengths
        self.matrix = np.zeros((len(piece_sizes), self.vocabulary.longest), np.int64)
        for r, c in enumerate(self.piece_codes):
            self.matrix[r, : len(c)] = c
        self.piece_alphabet, self.matrix = np.unique(self.matrix, return_inverse=True)
        self.inside = np.arange(self.vocabulary.longest) < self.vocabulary.lengths[:, None]
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {"": 0}
        self.flat, self.starts, self.sizes, self.chars = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(1, np.int64), 0

    def units(self, text: str) -> list[str]:
        """The text with its leading space, cut where no piece reaches across."""
        if not text:
            return []
        mark = next((c for c in SEPARATORS if c not in text), None)
        text = SPACE + text.replace(" ", SPACE)
        if mark is None:
            return re.findall(f"{SPACE}?[^{SPACE}]*", text)
        text = text.replace(SPACE, mark + SPACE)
        if self.vocabulary.cut_lines:
            text = text.replace("\n", f"{mark}\n{mark}")
        if self.vocabulary.cut:
            text = self.vocabulary.cut.sub(mark + r"\g<0>", text)
        return text.split(mark)

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, rank) of every occurrence of every piece."""
        v = self.vocabulary
        alphabet = np.unique(codes)  # 0, the separator, is first
        bits = max(1, int(len(alphabet)).bit_length())
        keys = suffix_keys(np.searchsorted(alphabet, codes), bits, v.longest)
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        place = np.minimum(np.searchsorted(alphabet, self.piece_alphabet), len(alphabet) - 1)
        present = (alphabet[place] == self.piece_alphabet) | (self.piece_alphabet == 0)
        usable = np.flatnonzero(present[self.matrix].all(axis=1))
        inside = self.inside[usable]
        at = place[self.matrix[usable]]
        low, high = np.where(inside, at, 0), np.where(inside, at, (1 << bits) - 1)
        pack = lambda m: [functools.reduce(lambda a, k: (a << bits) | (m[:, k] if k < v.longest else 0), range(s, s + 63 // bits), np.zeros(len(m), np.int64)) for s in range(0, v.longest, 63 // bits)]
        first, last = bisect(keys, pack(low), False), bisect(keys, pack(high), True)
        counts = last - first
        total = np.cumsum(counts)
        spots = np.arange(total[-1] if len(total) else 0) - np.repeat(total - counts, counts) + np.repeat(first, counts)
        return order[spots], np.repeat(usable, counts)

    def learn(self, words: list[str]) -> None:
        """Encode new units and keep the results."""
        v = self.vocabulary
        codes = np.frombuffer(("\0".join(words) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(sizes + 1) - sizes - 1
        separators = begin + sizes
        # A null character inside a word is no separator: it has no piece, and gets a code that no piece has.
        real = np.ones(len(codes), bool)
        real[separators] = False
        codes[real & (codes == 0)] = 0x110000
        position, rank = self.edges(codes)
        plain = np.zeros(len(codes), bool)
        plain[position[v.lengths[rank] == 1]] = True
        missing = np.flatnonzero(real & ~plain)
        position, rank = np.concatenate((position, missing)), np.concatenate((rank, np.full(len(missing), UNKNOWN)))
        size = np.where(rank == UNKNOWN, 1, v.lengths[rank])
        offset = position - np.repeat(begin, sizes + 1)[position]
        order = np.argsort(offset, kind="stable")
        position, rank, size, offset = position[order], rank[order], size[order], offset[order]
        none = -2
        last = np.full(len(codes) + 1, none, np.int64)
        bounds = np.searchsorted(offset, np.arange(int(sizes.max()) + 1))
        for step in range(len(bounds) - 1):
            s = slice(bounds[step], bounds[step + 1])
            p, r, z = position[s], rank[s], size[s]
            if step:
                before = last[p]
                good = before != none
                both = np.flatnonzero(good & (before >= 0) & (r >= 0))
                good[both] = v.compatible(before[both], r[both])
                p, r, z = p[good], r[good], z[good]
            last[p + z] = r
        where, word, found = separators.copy(), np.arange(len(words)), []
        while len(word):
            t = last[where]
            where = where - np.where(t == UNKNOWN, 1, v.lengths[t])
            found.append((word, t, where))
            going = where > begin[word]
            word, where = word[going], where[going]
        word, t, where = (np.concatenate([x[i] for x in found]) for i in range(3))
        order = np.lexsort((where, word))
        word, t, where = word[order], t[order], where[order]
        ids = np.where(t == UNKNOWN, -1, v.ids[t])
        repeat = np.ones(len(ids), np.int64)
        unknown = np.flatnonzero(t == UNKNOWN)
        if len(unknown):
            raw = [chr(c if c != 0x110000 else 0).encode("utf-8", "surrogatepass") for c in codes[where[unknown]]]
            repeat[unknown] = [len(x) for x in raw]
            ids, word = np.repeat(ids, repeat), np.repeat(word, repeat)
            ids[ids < 0] = v.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        counts = np.bincount(word, minlength=len(words))
        base, first = len(self.index), len(self.flat)
        self.index.update(zip(words, range(base, base + len(words)), strict=True))
        self.flat = np.concatenate((self.flat, ids.astype(np.int32)))
        self.starts = np.concatenate((self.starts, first + np.cumsum(counts) - counts))
        self.sizes = np.concatenate((self.sizes, counts))
        self.chars += int(sizes.sum())

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text)."""
        v = self.vocabulary
        split = [self.units(t) for t in texts]
        words = set().union(*split)
        words.discard(SPACE)
        if len(self.index) > MAX_CACHED_WORDS or self.chars > MAX_CACHED_CHARS:
            self.clear()
        new = list(words.difference(self.index))
        for low in range(0, len(new), LEARN_WORDS):
            self.learn(new[low : low + LEARN_WORDS])
        # A run of spaces before a word is a unit of its own; so is one at the end.
        units: list[int] = []
        per_text = np.zeros(len(texts), np.int64)
        runs: list[tuple[int, ...]] = []
        lone, base, index = v.runs.get(1), len(self.index), self.index
        for k, parts in enumerate(split):
            at = len(units)
            if SPACE not in parts:
                units += [index[w] for w in parts]
            else:
                spaces = 0
                for w in parts:
                    if w == "":
                        continue
                    if w != SPACE:
                        if spaces:
                            j = index[w]
                            joined = w[0] == SPACE and lone is not None and self.flat[self.starts[j]] == lone
                            units.append(base + len(runs))
                            runs.append(v.encode_run(spaces + joined) + (tuple(self.flat[self.starts[j] + 1 : self.starts[j] + self.sizes[j]].tolist()) if joined else tuple(self.flat[self.starts[j] : self.starts[j] + self.sizes[j]].tolist())))
                            spaces = 0
                        else:
                            units.append(index[w])
                    else:
                        spaces += 1
                if spaces:
                    units.append(base + len(runs))
                    runs.append(v.encode_run(spaces))
            per_text[k] = len(units) - at
        flat, starts, sizes = self.flat, self.starts, self.sizes
        if runs:
            extra = np.array([len(r) for r in runs], np.int64)
            starts, sizes = np.concatenate((starts, len(flat) + np.cumsum(extra) - extra)), np.concatenate((sizes, extra))
            flat = np.concatenate((flat, np.array([i for r in runs for i in r], np.int32)))
        u = np.array(units, np.int64)
        n, s = sizes[u], starts[u]
        end = np.cumsum(n)
        ids = flat[np.arange(end[-1] if len(end) else 0) - np.repeat(end - n, n) + np.repeat(s, n)]
        last = np.cumsum(per_text)
        ends = np.concatenate(([0], end))
        return ids, ends[last] - ends[last - per_text]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The UTF-8 bytes of each text; the space put before a text is taken off."""
        n = self.byte_len[ids]
        end = np.cumsum(n)
        pool = self.byte_pool[np.arange(end[-1] if len(end) else 0) - np.repeat(end - n, n) + np.repeat(self.byte_at[ids], n)].tobytes()
        ends = np.concatenate(([0], end))[np.concatenate(([0], np.cumsum(counts)))]
        return [pool[a:b].removeprefix(b" ") for a, b in zip(ends, ends[1:], strict=False)]


@functools.lru_cache(maxsize=2)
def encoder(model: bytes) -> Encoder:
    return Encoder(model)


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most BATCH_CHARS characters, one row at least."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        size = len(t or "")
        if i > start and held + size > BATCH_CHARS:
            yield start, i
            start, held = i, 0
        held += size
    if len(texts) > start:
        yield start, len(texts)


def encode_texts(docs: DataFrame, model_file: str | None = None, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `keep` columns with (ids, n_tokens, round_trip): every whole text encoded, decoded again and compared."""
    with open(model_file or default_model(), "rb") as f:
        model = f.read()
    text_batches(docs.sparkSession)
    slim = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = StructType(list(slim.select(*keep).schema)).add("ids", ArrayType(IntegerType())).add("n_tokens", IntegerType()).add("round_trip", BooleanType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(model)
        for batch in (x.slice(low, BATCH_ROWS) for x in batches for low in range(0, x.num_rows, BATCH_ROWS)):
            texts = batch.column(len(keep)).to_pylist()
            for a, b in slices(texts):
                part = texts[a:b]
                ids, counts = codec.encode([t or "" for t in part])
                same = [None if t is None else d == t.encode("utf-8", "surrogatepass") for t, d in zip(part, codec.decode(ids, counts), strict=True)]
                nulls = np.array([t is None for t in part])
                offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32), mask=np.append(nulls, False))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids))
                out = [batch.column(i).slice(a, b - a) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*out, lists, pa.array(counts.astype(np.int32), mask=nulls), pa.array(same, pa.bool_())], names=[*keep, "ids", "n_tokens", "round_trip"])
        codec.clear()  # the worker lives on between tasks

    return slim.mapInArrow(run, schema)


def decode_ids(rows: DataFrame, model_file: str | None = None, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `keep` columns with (text): ids decoded; null ids have a null text, bytes that are no UTF-8 become U+FFFD."""
    with open(model_file or default_model(), "rb") as f:
        model = f.read()
    slim = rows.select(*keep, F.col(ids_col).alias("__ids"))
    schema = StructType(list(slim.select(*keep).schema)).add("text", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(model)
        for batch in batches:
            lists = batch.column(len(keep)).to_pylist()
            counts = np.array([len(x or ()) for x in lists], np.int64)
            ids = np.array([i for x in lists for i in x or ()], np.int64)
            texts = [None if x is None else d.decode("utf-8", "replace") for x, d in zip(lists, codec.decode(ids, counts), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(texts, pa.string())], names=[*keep, "text"])

    return slim.mapInArrow(run, schema)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"))
