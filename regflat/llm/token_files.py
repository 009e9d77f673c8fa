"""Token ids of documents as Arrow files of equal-length sequences.

Documents are range-partitioned by id, so files in order hold the ids of all
documents in ascending order.  Each partition becomes two files in the Arrow
stream-file (IPC file) format below a shared folder:

* ``part-NNNNN.arrow``: record batches of fixed-size lists, ``ids`` (unsigned,
  two bytes while the vocabulary allows) and ``mask`` (false on the padding
  that fills up the last sequence of a file).  A memory-mapped reader gets
  sequence i by offset, without a copy.
* ``part-NNNNN.docs.arrow``: document id and number of ids, in order.

A task writes under a name of its own and renames when done, so a lost or
repeated task leaves no partial file.  Only one row per file (counts) goes
through the driver.

Encoding uses the tokenizers library, with its defaults, on units cut at
single spaces between other characters (a byte-level pre-tokenizer never joins
across such a space); a text with other runs of white space around a space, or
with a control string of the vocabulary (which is its one id, as by default),
is encoded as a whole.  Some MB of texts at a time are cut, and their different
units found, by Arrow; a unit that is letters and signs, in one line or more,
is put together from its letters and its signs, which are pre-tokens of their
own.  Ids of letters and of other units are kept in a bounded cache of each
worker in two generations, and gathered into the texts by numpy.

Defined results: a null text is empty and has the end id only; rows with equal
ids keep the order of their text's hash; null ids come first; an empty table
gives no files and no rows.  Only the named columns are read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LENGTH = 2048    # ids of a sequence
BATCH = 64       # sequences of a record batch
CACHE = 400_000  # units of a generation; a worker remembers two
GROUP = 64       # units encoded as one string
LETTERS = 256    # units of letters encoded as one string
SHORT = 256      # characters of a text encoded together with others
CHUNK = 8 << 20  # bytes of text cut into units at once (a longer text is a chunk of its own)

# what Python's ``\s`` matches, the space last
_SPACES = "\t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000 "
_encoders: dict[str, "Encoder"] = {}
# ASCII signs, without the apostrophe, which may begin a contraction
_SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
# letters since the first versions of Unicode: Latin, Greek, Cyrillic, Hebrew, Arabic, kana, Han, Hangul
_LETTERS = ("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u01f5\u0391-\u03a1\u03a3-\u03ce\u0401-\u040c\u040e-\u044f\u0451-\u045c"
            "\u05d0-\u05ea\u0621-\u063a\u0641-\u064a\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]+")
_WORD = re.compile("\n?" + _LETTERS)


def _byte_signs() -> np.ndarray:
    """The visible character by which a byte-level vocabulary writes each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = np.arange(256, dtype="<u4")
    out[np.setdiff1d(out, plain)] = 256 + np.arange(256 - len(plain))
    return out


_BYTES = _byte_signs()
_SPACE = chr(_BYTES[32])


_LINES = np.where(np.arange(256) == 10, 10, _BYTES).astype("<u4")  # line feeds stay


def _visible(text: str, table: np.ndarray = _BYTES) -> str:
    return table[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")


def _spread(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranges of ``counts`` numbers from ``begin`` on, one after another."""
    ends = np.cumsum(counts)
    return np.repeat(begin - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def _strings(column: pa.Array) -> list[str]:
    """Values that hold no space, by one string: several times as fast as a conversion of each."""
    whole = pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
    return pc.binary_join(whole, " ")[0].as_py().split(" ") if len(column) else []


class Encoder:
    """Ids of texts, as bytes of little-endian unsigned numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.control = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        cutter = self.tokenizer.pre_tokenizer
        signs_apart = cutter is not None and [len(x) for x, _ in cutter.pre_tokenize_str(" ab" + _SIGNS)] == [3, len(_SIGNS)]
        mark = self._ids("\n")
        # the line feed must be one id of its own between units
        self.mark = mark[0] if len(mark) == 1 and self._ids("a\n b").count(mark[0]) == 1 else None
        # letters and the signs behind them are pre-tokens of their own, so many units share their letters; and the bytes
        # of letters can go to the merges as they are
        self.letters = None
        if signs_apart and self.mark is not None and self.tokenizer.normalizer is None and [
                x for x, _ in cutter.pre_tokenize_str(" ab.\nc\u00e9 \u0416")] == [
                _visible(x) for x in (" ab", ".", "\n", "c\u00e9", " \u0416")]:
            self.letters = Tokenizer(self.tokenizer.model)
            self.letters.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
            vocabulary = self.tokenizer.get_vocab()
            self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
            self.spaced[[i for x, i in vocabulary.items() if x[0] == _SPACE]] = True

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of short texts; few of the library's results, which take many times their size, are held at once."""
        for lo in range(0, len(texts), 64):
            for e in self.tokenizer.encode_batch_fast(texts[lo:lo + 64], add_special_tokens=False):
                yield np.array(e.ids, self.dtype)

    def _learn_whole(self, units: list[str]) -> None:
        # a line feed between other characters is an id of its own, which the count below makes sure of
        plain = [u for u in units if self.mark is not None and "\n\n" not in u]
        rest = [] if len(plain) == len(units) else list(set(units).difference(plain))
        groups = [plain[i:i + GROUP] for i in range(0, len(plain), GROUP)]
        size = self.dtype.itemsize
        for group, ids in zip(groups, self._batch(["\n ".join(["", *g]) for g in groups])):
            cuts = np.flatnonzero(ids == self.mark).tolist()
            feeds = [u.count("\n") + 1 for u in group]
            if len(cuts) != sum(feeds):
                rest += group
                continue
            if len(cuts) != len(group):  # only the line feed before a unit parts it from its neighbour
                cuts = [cuts[i - n] for i, n in zip(accumulate(feeds), feeds)]
            data = ids.tobytes()
            for u, a, b in zip(group, cuts, [*cuts[1:], len(ids)]):
                self.units[u] = data[size * (a + 1):size * b]
        for u, ids in zip(rest, self._batch([" " + u for u in rest])):
            self.units[u] = ids.tobytes()

    def _learn_letters(self, words: list[str]) -> None:
        """Units of letters, given to the library as the pre-tokens that its pattern would find.

        The byte of the space begins every unit and is nowhere else, so the ids that begin with it part the units; one
        after a line feed follows a space alone, which gives way to the line feed.
        """
        feed = np.array([self.mark], self.dtype).tobytes()
        for lines in (False, True):
            some = [w for w in words if (w[0] == "\n") == lines]
            between, skip = ("\n \n", 1) if lines else ("\n ", 0)
            for lo in range(0, len(some), 64 * LETTERS):
                groups = [some[i:i + LETTERS] for i in range(lo, min(lo + 64 * LETTERS, len(some)), LETTERS)]
                joined = [_visible(between.join(["", *(w[skip:] for w in g)])[1:], _LINES) for g in groups]
                for g, e in zip(groups, self.letters.encode_batch_fast(joined, add_special_tokens=False)):
                    ids = np.array(e.ids, self.dtype)
                    cuts = np.flatnonzero(self.spaced[ids])
                    if len(cuts) != len(g):
                        raise ValueError(f"{len(g)} units came back as {len(cuts)}")
                    ends = (self.dtype.itemsize * np.append(cuts[1:], len(ids))).tolist()
                    starts = (self.dtype.itemsize * (cuts + skip)).tolist()
                    data = ids.tobytes()
                    self.units.update((w, feed + data[i:j]) if lines else (w, data[i:j]) for w, i, j in zip(g, starts, ends))

    def _known(self, units: list[str]) -> list[bytes]:
        """Ids of different units with the space before them; of letters after a line feed with the line feed."""
        if len(self.units) > CACHE:
            self.units, self.older = {}, self.units
        known, older = self.units, self.older
        out = list(map(known.get, units))
        missing = [u for u, x in zip(units, out) if x is None]
        if missing and older:  # looked up: an intersection with a dictionary goes through all of it
            known.update([(u, older[u]) for u in missing if u in older])
            missing = [u for u in missing if u not in known]
        if missing:
            words = [] if self.letters is None else [u for u in missing if _WORD.fullmatch(u)]
            self._learn_letters(words)
            self._learn_whole(missing if not words else list(set(missing).difference(words)))
        return [known[u] if x is None else x for u, x in zip(units, out)]

    def _ids_of_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different units one after another, with the space before them, and how many each has."""
        if not len(units):
            return np.empty(0, self.dtype), np.empty(0, np.int64)
        # lines of letters with signs behind them; a unit that holds anything else stays whole
        cut = pc.split_pattern(units, "\n")
        count = cut.value_lengths().to_numpy().astype(np.int64)
        begin = np.cumsum(count) - count
        line = cut.flatten()
        word = pc.utf8_rtrim(line, _SIGNS)
        letters = pc.match_substring_regex(word, f"^{_LETTERS}$").to_numpy(zero_copy_only=False)
        split = np.logical_and.reduceat(letters, begin) & (self.letters is not None)
        at = _spread(begin, np.where(split, count, 1))  # the lines of a unit, or the one that stands for the whole
        head = np.zeros(len(line), bool)
        head[begin] = True
        head, apart = head[at], np.repeat(split, count)[at]
        names = pa.concat_arrays([word.take(pa.array(at[head & apart])), pc.binary_join_element_wise(
            "\n", word.take(pa.array(at[~head])), ""), units.filter(pa.array(~split))]).dictionary_encode()
        code = np.empty(len(at), np.int64)
        code[np.concatenate([np.flatnonzero(head & apart), np.flatnonzero(~head), np.flatnonzero(~apart)])] = names.indices
        # the signs behind the letters
        ends = np.frombuffer(line.buffers()[1], np.int32)[line.offset + 1:line.offset + len(line) + 1][at]
        n = np.where(apart, (pc.binary_length(line).to_numpy() - pc.binary_length(word).to_numpy())[at], 0)
        signs = np.frombuffer(line.buffers()[2], np.uint8)[_spread(ends - n, n)]
        tails = pa.StringArray.from_buffers(len(n), pa.py_buffer(np.append(0, np.cumsum(n)).astype(np.int32)),
                                            pa.py_buffer(signs)).dictionary_encode()
        if len(self.tails) > CACHE:
            self.tails = {}
        behind = tails.dictionary.to_pylist()
        for x in behind:
            if x not in self.tails:
                self.tails[x] = np.array(self._ids(x), self.dtype).tobytes()
        pieces = [*self._known(_strings(names.dictionary)), *map(self.tails.__getitem__, behind)]
        size = np.fromiter(map(len, pieces), np.int64, len(pieces)) // self.dtype.itemsize
        order = np.stack([code, tails.indices.to_numpy() + len(names.dictionary)], axis=1)
        ids = np.frombuffer(b"".join(pieces), self.dtype)[_spread((np.cumsum(size) - size)[order.ravel()], size[order.ravel()])]
        return ids, np.add.reduceat(size[order].sum(axis=1), np.flatnonzero(head))

    def _whole(self, units: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Units with white space at an end (so it stands beside a space) or with a control string, empty ones too; and
        texts with a control string that holds a space."""
        size = pc.binary_length(units).to_numpy()
        odd = (size == 0) | (pc.binary_length(pc.utf8_trim(units, _SPACES)).to_numpy() < size)
        text = np.zeros(len(texts), bool)
        for x in self.control:
            if " " in x:
                text |= pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
            else:
                odd |= pc.match_substring(units, x).to_numpy(zero_copy_only=False)
        return odd, text

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text; of null, none."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        texts = texts.cast(pa.string()).fill_null("")
        n = len(texts)
        if not n:
            return []
        cut = pc.split_pattern(texts, " ")
        coded = cut.flatten().dictionary_encode()
        code = coded.indices.to_numpy()
        at = np.concatenate([[0], np.cumsum(cut.value_lengths().to_numpy().astype(np.int64))])  # one unit at least a text
        del cut
        odd, whole = self._whole(coded.dictionary, texts)
        if odd.any():
            whole |= np.logical_or.reduceat(odd[code], at[:-1])
        # the first unit of a text has no space before it; it or the whole text stands for itself
        first = at[:-1]
        own = coded.dictionary.take(pa.array(code[first])).to_pylist()
        for i in np.flatnonzero(whole).tolist():
            own[i] = texts[i].as_py()
        short = self._batch([x for x in own if len(x) <= SHORT])
        own = [next(short) if len(x) <= SHORT else np.array(self._ids(x), self.dtype) for x in own]
        skip = np.repeat(whole, np.diff(at))
        skip[first] = True
        wanted = np.zeros(len(odd), bool)
        wanted[code[~skip]] = True
        index = np.cumsum(wanted) - 1 + n  # where the ids of a unit stand, after those of the texts' own
        known, size = self._ids_of_units(coded.dictionary.filter(pa.array(wanted)))
        del coded
        store = np.concatenate([*own, known])
        size = np.concatenate([list(map(len, own)), size])
        begin = np.cumsum(size) - size
        place = index[code]
        place[first] = np.arange(n)
        counts = size[place]
        counts[skip] = 0
        counts[first] = size[:n]
        ends = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(ends[-1], self.dtype)
        for lo in range(0, len(place), 1 << 19):  # an id takes 16 bytes while it is looked up
            hi = min(lo + (1 << 19), len(place))
            out[ends[lo]:ends[hi]] = store[_spread(begin[place[lo:hi]], counts[lo:hi])]
        data = out.tobytes()
        text = (ends[at] * self.dtype.itemsize).tolist()
        return [data[a:b] for a, b in zip(text, text[1:])]


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``CHUNK`` bytes, or of one text."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64))
    lo, base = 0, 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, base + CHUNK, side="right")))
        yield lo, hi
        lo, base = hi, int(ends[hi - 1])


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _schema(dtype: np.dtype, length: int) -> pa.Schema:
    value = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
    return pa.schema([pa.field("ids", pa.list_(value, length)), pa.field("mask", pa.list_(pa.bool_(), length))])


class _SequenceFile:
    """Appends ids; closes with a padded last sequence."""

    def __init__(self, sink, dtype: np.dtype, length: int):
        self.schema, self.dtype, self.length = _schema(dtype, length), dtype, length
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.rest, self.n, self.sequences = b"", 0, 0

    def add(self, ids: bytes, last: bool = False) -> None:
        self.n += len(ids) // self.dtype.itemsize
        data = self.rest + ids
        step = self.dtype.itemsize * self.length * BATCH
        at = 0
        while len(data) - at >= step or (last and at < len(data)):
            piece = np.frombuffer(data[at:at + step], self.dtype)
            at += step
            rows = -(-len(piece) // self.length)
            full = np.zeros(rows * self.length, self.dtype)
            full[:len(piece)] = piece
            mask = np.arange(rows * self.length) < len(piece)
            self.writer.write_batch(pa.record_batch([
                pa.FixedSizeListArray.from_arrays(pa.array(full), self.length),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))
            self.sequences += rows
        self.rest = data[at:]


def _write_rows(folder: str, tokenizer: str, end_id: int, length: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        where, root = fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        part = context.partitionId()
        name = f"{root}/part-{part:05d}"
        own = f"{root}/_attempt-{part:05d}-{context.taskAttemptId()}"
        listed = pa.schema([("doc_id", id_type), ("n_tokens", pa.int64())])
        out = docs = None
        end = np.array([end_id], enc.dtype).tobytes()
        count = 0
        for batch in batches:
            for lo, hi in _chunks(batch.column("text")):
                piece = batch.slice(lo, hi - lo)
                if out is None:
                    sinks = [where.open_output_stream(own + x) for x in (".arrow", ".docs.arrow")]
                    out = _SequenceFile(sinks[0], enc.dtype, length)
                    docs = pa.ipc.new_file(sinks[1], listed)
                ids = [x + end for x in enc.encode(piece.column("text"))]
                count += len(ids)
                for i in range(0, len(ids), 256):  # a reader holds the ids of as many documents
                    out.add(b"".join(ids[i:i + 256]))
                    docs.write_batch(pa.record_batch([
                        piece.column("id").slice(i, 256).cast(id_type),
                        pa.array([len(x) // enc.dtype.itemsize for x in ids[i:i + 256]], pa.int64())], schema=listed))
        if out is None:
            return
        out.add(b"", last=True)
        out.writer.close(), docs.close()
        for s in sinks:
            s.close()
        for x in (".arrow", ".docs.arrow"):
            where.move(own + x, name + x)
        yield pa.record_batch({"part": pa.array([part], pa.int32()), "n_docs": pa.array([count], pa.int64()),
                               "n_ids": pa.array([out.n], pa.int64()), "n_sequences": pa.array([out.sequences], pa.int64())})
    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", length: int = LENGTH) -> list[dict]:
    """Write the files; returns one dict per file (part, n_docs, n_ids, n_sequences), in order."""
    spark = docs.sparkSession
    # an empty batch has the Arrow type of the id column
    kind = docs.select(id_col).limit(0).toArrow().schema.field(0).type
    where, root = fs.FileSystem.from_uri(folder)
    where.create_dir(root, recursive=True)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("id").asc_nulls_first(), F.col("h")]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("h")).repartitionByRange(n, *order).sortWithinPartitions(*order)
    made = rows.select("id", "text").mapInArrow(_write_rows(folder, tokenizer, end_id, length, kind),
                                                "part int, n_docs long, n_ids long, n_sequences long")
    return sorted((r.asDict() for r in made.collect()), key=lambda r: r["part"])


def open_sequences(path: str) -> pa.ipc.RecordBatchFileReader:
    """Reader of one file, memory-mapped where the folder is local."""
    where, name = fs.FileSystem.from_uri(path)
    source = pa.memory_map(name) if isinstance(where, fs.LocalFileSystem) else where.open_input_file(name)
    return pa.ipc.open_file(source)


def sequence(reader: pa.ipc.RecordBatchFileReader, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids (a view of the file) and mask of sequence ``i`` of a file."""
    batch = reader.get_batch(i // BATCH)
    length = batch.schema.field("ids").type.list_size
    ids, mask = batch.column("ids"), batch.column("mask")
    j = i % BATCH
    return (ids.values.slice(j * length, length).to_numpy(zero_copy_only=True),
            mask.values.slice(j * length, length).to_numpy(zero_copy_only=False))


def documents_of(folder: str, part: int) -> Iterator[tuple[pa.Array, np.ndarray, list[np.ndarray]]]:
    """Read back a file: per batch of its index (ids, start of each document in the file, its token ids)."""
    with open_sequences(f"{folder}/part-{part:05d}.arrow") as reader, \
            open_sequences(f"{folder}/part-{part:05d}.docs.arrow") as index:
        held, base, at, k = np.empty(0, np.uint16), 0, 0, 0
        for i in range(index.num_record_batches):
            docs = index.get_batch(i)
            n = docs.column("n_tokens").to_numpy()
            starts = at + np.concatenate([[0], np.cumsum(n)[:-1]])
            stop = at + int(n.sum())
            pieces = [held[at - base:]]
            have = base + len(held)
            while have < stop:
                pieces.append(reader.get_batch(k).column("ids").values.to_numpy(zero_copy_only=True))
                have += len(pieces[-1])
                k += 1
            held, base = (np.concatenate(pieces) if len(pieces) > 1 else pieces[0]), at
            yield docs.column("doc_id"), starts, [held[s - base:s - base + m] for s, m in zip(starts.tolist(), n.tolist())]
            at = stop


def _read_rows(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before in zip(batch.column("part").to_pylist(), batch.column("before").to_pylist()):
                for ids, starts, tokens in documents_of(folder, part):
                    yield pa.record_batch({
                        "id": ids, "start": pa.array(starts + before, pa.int64()),
                        "n_tokens": pa.array([len(t) for t in tokens], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(t.astype("<u4").tobytes()) for t in tokens], pa.int64())})
    return run


def read_tokens(spark: SparkSession, folder: str, files: list[dict], id_type: str, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files: id, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32``."""
    before, rows = 0, []
    for f in files:
        rows.append((f["part"], before))
        before += f["n_ids"]
    table = spark.createDataFrame(rows, "part int, before long").repartitionByRange(max(1, len(rows)), "part")
    return table.mapInArrow(_read_rows(folder), f"id {id_type}, start long, n_tokens long, ids_crc32 long") \
        .withColumnRenamed("id", id_col)
