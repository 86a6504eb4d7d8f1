"""Token ids of all documents in shards of raw ids, with an index for access by key.

A shard is a file of the ids alone, little-endian, 2 bytes each where the vocabulary
allows and 4 otherwise; documents lie in it by key, and shards by key too. The index is
a minimal perfect hash (hash and displace): a key's hash names a bucket, the bucket's
stored displacement turns the hash into the key's own slot, and the slot holds a
fingerprint of the key and where its ids lie. A look-up reads one bucket number, one
displacement and one slot whatever the number of keys, and a key that was never written
is told apart by its fingerprint. The index is cut into parts by another hash of the key,
so that no task holds it whole.

    shard-NNNNN.ids    ids
    index-NNNNN.mph    header, displacements (u4), then one record per key (``RECORD``)
    manifest (table)   shard, first and number of ids
    parts (table)      part, file, number of keys

Documents with the same key lie next to each other, maybe over several shards; the index
holds the first of them and their number. A null key comes first. Null and empty texts
hold the end id alone. All files go to one folder that executors and driver share; they
are written under a name of their own and then renamed, so a task that ran twice or
was lost leaves no half file.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lagscope.llm import lexing as lx

END_ID = 1
KEYS_PER_BUCKET = 4
#: Least keys of a part of the index, and most parts.
KEYS_PER_PART = 1 << 12
MOST_PARTS = 1 << 16
#: By chance one seed in 10**9 fails for a part of 100,000 keys.
MOST_SEEDS = 16
RECORD = np.dtype([("fingerprint", "<u8"), ("shard", "<u4"), ("copies", "<u4"), ("offset", "<u8"), ("n_tokens", "<u8")])
#: Ids of about so many words are kept between batches, at some 50 bytes each.
KEPT_WORDS = 400_000


def key_hashes(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of keys of any type, of unlike sums; null has a pair of its own."""
    text = keys.cast(pa.string())
    data, offsets = lx.text_bytes(text)
    none = text.is_null().to_numpy(zero_copy_only=False)
    sizes = lx.mix(np.diff(offsets).astype(np.uint64) + np.uint64(7))
    pair = []
    for values, salt in ((lx.BYTE_VALUES[data], 0x51), (lx.mix(lx.BYTE_VALUES[data]), 0xF1)):
        hashes = lx.stretch_hashes(lx.prefix_hashes(values), offsets[:-1], offsets[1:]) ^ sizes
        pair.append(lx.mix(np.where(none, np.uint64(0x5EED), hashes) ^ np.uint64(salt)))
    return pair[0], pair[1]


def seeded(hashes: np.ndarray, prints: np.ndarray, seed: int) -> np.ndarray:
    """One hash of both, another one for every seed."""
    return lx.mix(hashes ^ lx.mix(prints + np.uint64(seed)))


def choose_seed(hashes: np.ndarray, prints: np.ndarray) -> int:
    """A seed under which all keys have different hashes, so that each can have a slot. Keys
    that agree in one hash are told apart by the other; those that agree in both are refused."""
    for seed in range(MOST_SEEDS):
        if len(np.unique(seeded(hashes, prints, seed))) == len(hashes):
            return seed
    raise ValueError("different keys with equal 128-bit hashes")


def _slots(hashes: np.ndarray, moves: np.ndarray, n: int) -> np.ndarray:
    return (lx.mix(hashes ^ lx.mix(moves + np.uint64(1))) % np.uint64(n)).astype(np.int64)


def build_mph(hashes: np.ndarray) -> np.ndarray:
    """Displacement of each bucket so that n different hashes fall on n different slots."""
    n = len(hashes)
    if len(np.unique(hashes)) < n:
        raise ValueError("equal hashes have no slots of their own")
    n_buckets = max(1, -(-n // KEYS_PER_BUCKET))
    bucket = (hashes % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    first = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    moves = np.zeros(n_buckets, np.uint32)
    free = np.ones(n, bool)
    # The fullest buckets first, while most slots are free.
    for b in np.argsort(-np.diff(first), kind="stable"):
        own = hashes[order[first[b] : first[b + 1]]]
        if not len(own):
            break
        tried = 0
        while True:
            tries = np.arange(tried, tried + 64, dtype=np.uint64)
            slots = _slots(own[None, :], tries[:, None], n)
            good = free[slots].all(axis=1)
            if len(own) > 1:
                ordered = np.sort(slots, axis=1)
                good &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if good.any():
                pick = int(good.argmax())
                moves[b] = tried + pick
                free[slots[pick]] = False
                break
            tried += 64
    return moves


def find_slots(hashes: np.ndarray, moves: np.ndarray, n: int) -> np.ndarray:
    return _slots(hashes, moves[(hashes % np.uint64(len(moves))).astype(np.int64)].astype(np.uint64), n)


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder; a plain path is taken as it is."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class _Output:
    """A file that appears under its name when it is complete."""

    def __init__(self, folder: str, name: str):
        self.store, path = _store(folder)
        self.store.create_dir(path, recursive=True)
        self.name, self.own = f"{path}/{name}", f"{path}/{name}.{uuid.uuid4().hex}.part"
        self.stream = self.store.open_output_stream(self.own)

    def close(self) -> None:
        self.stream.close()
        try:
            self.store.move(self.own, self.name)
        except OSError:
            # Some stores do not replace a file: another run of this task was first.
            if self.store.get_file_info(self.name).type == fs.FileType.NotFound:
                raise
            self.store.delete_file(self.own)


# How a tokenizer that is encoded word by word normalizes and cuts its texts.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMAL = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
CUTS = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": PIECES}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: Words of these characters need no Unicode normalization and lower-case letter by letter.
PLAIN = r"[\x21-\x7e\xa1-\u012f\u0131-\u017f]+"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it
    prints, and else the next one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


def _kinds() -> np.ndarray:
    """White space 0, ASCII letters 1, digits 2, other printing ASCII 3, and the rest 4, with
    the apostrophe, at which the pattern looks at the letters that follow."""
    kinds = np.full(256, 3, np.uint8)
    kinds[lx.WHITE] = 0
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
    kinds[0x30:0x3A] = 2
    kinds[[*range(0x09), *range(0x0E, 0x20), 0x27, *range(0x7F, 0x100)]] = 4
    return kinds


KINDS = _kinds()
#: Words with a character of the last kind.
ODD = re.compile(rb"[\x00-\x08\x0e-\x1f'\x7f-\xff]")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Units(lx.Words):
    """Words, those of plain ASCII cut where the tokenizer's pattern cuts them: between
    letters, other signs and single digits. ASCII letters are lower-cased."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self._hashes = LOWER[data], offsets, None
        kinds = KINDS[data]
        inside = kinds > 0
        starts, ends = lx.runs(inside, offsets)
        odd = np.zeros(len(data) + 1, np.int32)
        np.cumsum(kinds == 4, out=odd[1:])
        whole = np.repeat(odd[ends] > odd[starts], ends - starts)
        at = np.flatnonzero(inside)
        begins = np.zeros(len(data) + 1, bool)
        cut = np.zeros(len(data), bool)
        cut[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == 2)
        begins[at] = cut[at] & ~whole
        begins[starts] = True
        self.starts = np.flatnonzero(begins)
        begins[ends] = True
        # A unit ends where the next one begins or its word does.
        marks = np.flatnonzero(begins)
        self.ends = marks[np.searchsorted(marks, self.starts) + 1]
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)


class _Ids:
    """Ids of words by their hash, in sorted arrays; the words longest unused go first."""

    def __init__(self, width: np.dtype):
        self.hashes, self.flat = np.zeros(0, np.uint64), np.zeros(0, width)
        self.begin, self.size, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.now = 0

    def unknown(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        return np.flatnonzero(self.hashes[at] != hashes) if len(self.hashes) else np.arange(len(hashes))

    def add(self, hashes: np.ndarray, ids: list[int], sizes: list[int]) -> None:
        """``hashes`` sorted and none of them known."""
        size = np.array(sizes, np.int64)
        columns = [hashes, len(self.flat) + np.cumsum(size) - size, size, np.full(len(size), self.now)]
        at = np.searchsorted(self.hashes, hashes)
        own = [self.hashes, self.begin, self.size, self.used]
        self.hashes, self.begin, self.size, self.used = (np.insert(c, at, new) for c, new in zip(own, columns, strict=True))
        self.flat = np.concatenate((self.flat, np.array(ids, self.flat.dtype)))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``flat`` the ids of known words begin, and their number."""
        at = np.searchsorted(self.hashes, hashes)
        self.used[at] = self.now
        return self.begin[at], self.size[at]

    def make_room(self, most: int) -> None:
        """Before the next words: if there are more than ``most``, the half used last stays."""
        self.now += 1
        if len(self.hashes) <= most:
            return
        kept = np.sort(np.argsort(-self.used, kind="stable")[: most // 2])
        begin, size = self.begin[kept], self.size[kept]
        first = np.cumsum(size) - size
        self.flat = self.flat[np.arange(size.sum()) + np.repeat(begin - first, size)]
        self.hashes, self.begin, self.size, self.used = self.hashes[kept], first, size, self.used[kept]


class Encoder:
    """Ids of texts, each white-space-separated word encoded once and remembered.

    That holds for a tokenizer that splits at white space and drops it, as ``NORMAL`` and
    ``CUTS`` say: the ids of a text are those of its words in a row. A plain word is cut by the
    tokenizer's pattern and its pieces go to the tokenizer's model; any other word goes through
    the whole tokenizer. Any other tokenizer gets whole texts.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        settings = json.loads(self.tokenizer.to_str())
        self.by_words = (settings["normalizer"], settings["pre_tokenizer"]) == (NORMAL, CUTS)
        self.width = np.dtype("<u2") if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.dtype("<u4")
        self.known = _Ids(self.width)
        self.cut, self.plain = regex.compile(PIECES).findall, regex.compile(PLAIN).fullmatch
        self.letters = _byte_letters()
        self.marks = tuple({t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()})

    def _learn(self, hashes: np.ndarray, words: list[bytes], whole: bool) -> None:
        """``whole``: words may hold what the pattern cuts; else only ``ODD`` ones do, and all
        others are pieces."""
        tokenize, letters, odd = self.tokenizer.model.tokenize, self.letters, ODD.search
        found: list = [None] * len(words)
        others = []
        for i, word in enumerate(words):
            if not whole and not odd(word):
                found[i] = [t.id for t in tokenize(word.decode())]
                continue
            text = word.decode()
            if not self.plain(text) or any(m in text for m in self.marks):
                others.append(i)
                continue
            ids = found[i] = []
            for piece in self.cut(text.lower()):
                spelled = piece if piece.isascii() else "".join([letters[b] for b in piece.encode()])
                ids += [t.id for t in tokenize(spelled)]
        texts = [words[i].decode() for i in others]
        for i, encoded in zip(others, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            found[i] = encoded.ids
        self.known.add(hashes, [x for ids in found for x in ids], [len(ids) for ids in found])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, with ``END_ID`` after each text, and the number of ids of each text."""
        raw = data.tobytes()
        if not self.by_words:
            return self._encode_whole([raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
        # Added tokens are looked for before letters are lower-cased.
        plain = not any(mark.encode() in raw for mark in self.marks)
        words = Units(data, offsets) if plain else lx.Words(data, offsets)
        # Whole words and their units may be spelled alike and are kept apart.
        hashes = words.hashes if plain else lx.mix(words.hashes)
        hashes, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        self.known.make_room(KEPT_WORDS)
        new = self.known.unknown(hashes)
        if len(new):
            raw = words.data.tobytes() if plain else raw
            spans = zip(words.starts[first[new]].tolist(), words.ends[first[new]].tolist(), strict=True)
            self._learn(hashes[new], [raw[a:b] for a, b in spans], not plain)
        begin, size = self.known.find(hashes)
        return self._lay_out(begin[place], size[place], words)

    def _encode_whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.array([x for own in encoded for x in (*own, END_ID)], self.width)
        return ids, np.array([len(own) + 1 for own in encoded], np.int64)

    def _lay_out(self, begin: np.ndarray, size: np.ndarray, words: lx.Words) -> tuple[np.ndarray, np.ndarray]:
        n_texts = len(words.counts)
        flat = np.append(self.known.flat, self.width.type(END_ID))
        # Each word, and one more for the end of each text, after its last word.
        ends = words.first[1:]
        n = np.insert(size, ends, 1)
        source = np.insert(begin, ends, len(flat) - 1)
        total = lx.per_text(size, words.first) + 1 if n_texts else np.zeros(0, np.int64)
        steps = np.arange(n.sum()) + np.repeat(source - (np.cumsum(n) - n), n)
        return flat[steps], total


def kept_encoder(file: str) -> Encoder:
    """The encoder of this worker process: the tokenizer is read once, and words that one task
    has met need not be encoded in the next. It is held by the ``tokenizers`` module, since
    this one comes anew with every task."""
    import tokenizers

    kept = vars(tokenizers).setdefault("_lagscope_encoders", {})
    status = os.stat(file)
    name = (file, status.st_mtime_ns, status.st_size)
    if name not in kept:
        kept.clear()
        kept[name] = Encoder(file)
    return kept[name]


def _writer(folder: str, file: str):
    """Encode one sorted partition into its shard; yields where each document lies."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        encoder, out, found, at = None, None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                encoder, out = kept_encoder(file), _Output(folder, f"shard-{shard:05d}.ids")
            data, offsets = lx.text_bytes(batch.column("text"))
            totals = []
            for a, b in lx.pieces(offsets, 2 * lx.PIECE):
                ids, total = encoder.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                out.stream.write(ids.tobytes())
                totals.append(total)
            n = np.concatenate(totals)
            found.append(pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(n), shard), pa.int32()), batch.column("key"),
                    pa.array(at + np.cumsum(n) - n, pa.int64()), pa.array(n, pa.int64()),
                ],
                names=["shard", "key", "offset", "n_tokens"],
            ))
            at += int(n.sum())
        if out is not None:
            out.close()
        yield from found

    return lx.tidy(write)


def _indexer(folder: str, parts: int):
    """Build the index of the keys of each part."""

    def index(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        hashes, prints = key_hashes(table.column("key").combine_chunks())
        seed = choose_seed(hashes, prints)
        slots = seeded(hashes, prints, seed)
        moves = build_mph(slots)
        records = np.zeros(len(hashes), RECORD)
        at = find_slots(slots, moves, len(hashes))
        records["fingerprint"][at] = prints
        for name in ("shard", "copies", "offset", "n_tokens"):
            records[name][at] = table.column(name).to_numpy()
        head = np.array([len(hashes), len(moves), seed], "<u8")
        out = _Output(folder, f"index-{part:05d}.mph")
        for piece in (head, moves.astype("<u4"), records):
            out.stream.write(piece.tobytes())
        out.close()
        return pa.table({"part": pa.array([part], pa.int32()), "keys": pa.array([len(hashes)], pa.int64())})

    return index


def load_part(folder: str, part: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Seed, displacements and records."""
    store, path = _store(folder)
    with store.open_input_file(f"{path}/index-{part:05d}.mph") as file:
        raw = file.read()
    n, buckets, seed = np.frombuffer(raw, "<u8", 3).tolist()
    moves = np.frombuffer(raw, "<u4", buckets, 24)
    return seed, moves, np.frombuffer(raw, RECORD, n, 24 + 4 * buckets)


def look_up(keys: pa.Array, seed: int, moves: np.ndarray, records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The record of each key, and whether the key was written at all."""
    hashes, prints = key_hashes(keys)
    at = records[find_slots(seeded(hashes, prints, seed), moves, len(records))]
    return at, at["fingerprint"] == prints


class TokenFiles:
    """Written shards and index; see ``write_tokens``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.manifest = spark.read.parquet(f"{folder}/manifest")
        self.documents = spark.read.parquet(f"{folder}/documents")
        self.n_parts = int(spark.read.parquet(f"{folder}/parts").agg(F.max("n_parts")).first()[0] or 0)

    def locate(self, keys: DataFrame, key: str) -> DataFrame:
        """Where each of ``keys`` lies, from the index alone; keys never written get no row."""
        folder, parts = self.folder, self.n_parts

        def with_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                part = _part_of(key_hashes(batch.column("key"))[0], parts)
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(part)], names=["key", "part"])

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: tuple[int, tuple] | None = None
            for batch in batches:
                part_of = batch.column("part").to_numpy()
                for part in np.unique(part_of):
                    if held is None or held[0] != part:
                        held = int(part), load_part(folder, int(part))
                    own = batch.column("key").filter(pa.array(part_of == part))
                    record, known = look_up(own, *held[1])
                    columns = [pa.array(record[n][known].astype(np.int64)) for n in ("shard", "offset", "n_tokens", "copies")]
                    yield pa.RecordBatch.from_arrays(
                        [own.filter(pa.array(known)), *columns], names=["key", "shard", "offset", "n_tokens", "copies"]
                    )

        kind = keys.schema[key].dataType.simpleString()
        rows = keys.select(F.col(key).alias("key"))
        if not parts:
            return self.spark.createDataFrame([], f"key {kind}, shard long, offset long, n_tokens long, copies long")
        parted = rows.distinct().mapInArrow(with_part, f"key {kind}, part int")
        # Sorted, so that a task holds one part of the index at a time.
        return parted.repartition("part").sortWithinPartitions("part").mapInArrow(
            find, f"key {kind}, shard long, offset long, n_tokens long, copies long"
        )

    def everywhere(self, located: DataFrame) -> DataFrame:
        """From ``locate``: (key, shard, offset, n_tokens) of all documents of each key, also
        where several share one."""
        columns = ["key", "shard", "offset", "n_tokens"]
        shared = located.filter(F.col("copies") > 1).select("key").withColumnRenamed("key", "_key")
        copies = self.documents.join(shared, F.col("key").eqNullSafe(F.col("_key")), "left_semi")
        return located.filter(F.col("copies") == 1).select(*columns).unionByName(copies.select(*columns))

    def read(self, places: DataFrame, use, schema: str) -> DataFrame:
        """Apply ``use(key, start, ids)`` -> row to each of ``places`` (key, shard, offset,
        n_tokens); ``start`` is the number of ids of all documents before.

        Each task reads its stretches of a shard in order, one document at a time.
        """
        folder, names = self.folder, [f.split()[0] for f in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            open_shard, file = None, None
            store, path = _store(folder)
            for batch in batches:
                rows = []
                columns = (batch.column(n).to_pylist() for n in ("key", "shard", "first", "offset", "n_tokens", "width"))
                for key, shard, first, offset, size, width in zip(*columns, strict=True):
                    if shard != open_shard:
                        if file is not None:
                            file.close()
                        file, open_shard = store.open_input_file(f"{path}/shard-{shard:05d}.ids"), shard
                    raw = file.read_at(size * width, offset * width)
                    rows.append(use(key, first + offset, np.frombuffer(raw, f"<u{width}")))
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=to_arrow)
            if file is not None:
                file.close()

        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import _parse_datatype_string

        to_arrow = to_arrow_schema(_parse_datatype_string(schema))
        slices = F.floor(F.col("offset") / F.lit(1 << 22))
        placed = places.join(self.manifest.select("shard", "first", "width"), "shard")
        in_order = placed.repartition("shard", slices).sortWithinPartitions("shard", "offset")
        return in_order.mapInArrow(run, schema)


def write_tokens(docs: DataFrame, folder: str, file: str, key: str = "doc_id", text: str = "text") -> TokenFiles:
    """Encode all documents in ascending order of their key into ``folder``, which must be new."""
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # The hash and the row number split a key that holds a large share of all rows.
    ties = [F.xxhash64("text"), F.monotonically_increasing_id()]
    ordered = rows.withColumns({"_tie": ties[0], "_row": ties[1]}).repartitionByRange("key", "_tie", "_row")
    ordered = ordered.sortWithinPartitions("key", "_tie", "_row").select("key", "text")
    placed = ordered.mapInArrow(_writer(folder, file), f"shard int, key {kind}, offset long, n_tokens long")
    placed.write.parquet(f"{folder}/documents")
    placed = spark.read.parquet(f"{folder}/documents")
    width = Encoder(file).width.itemsize
    # The driver reads the tokenizer for its width alone and need not keep that memory.
    lx.give_back()
    # One row per shard goes through one task.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = placed.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"))
    first = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first")
    shards.select("shard", first, "n_tokens", F.lit(width).alias("width")).write.parquet(f"{folder}/manifest")
    where = F.min(F.struct("shard", "offset", "n_tokens"))
    keys = placed.groupBy("key").agg(where.alias("at"), F.count(F.lit(1)).alias("copies"))
    n_parts = min(max(1, -(-placed.count() // KEYS_PER_PART)), MOST_PARTS)

    def with_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("part", pa.array(_part_of(key_hashes(batch.column("key"))[0], n_parts)))

    flat = keys.select("key", "at.*", "copies")
    fields = f"key {kind}, shard int, offset long, n_tokens long, copies long, part int"
    built = flat.mapInArrow(with_part, fields).groupBy("part").applyInArrow(_indexer(folder, n_parts), "part int, keys long")
    built.withColumn("n_parts", F.lit(n_parts)).write.parquet(f"{folder}/parts")
    return TokenFiles(spark, folder)


def crc_of(key, start: int, ids: np.ndarray) -> tuple:
    """Key, start, number of ids, and the crc32 of the ids at 4 bytes each."""
    return key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())
