"""Two tokenizers over one corpus: where their tokens end together, and which ids meet."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sunledger.llm.common import cut, pieces

# The vocabulary files; the driver reads them and sends their bytes (2 MB) along with the tasks.
BYTE_FILE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_FILE = "/opt/tokenizers/piece_bpe_32k.model"
# Fixed: how byte-level vocabularies cut a text before their merges.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Id pairs that may be sent to every task; beyond that frequent pairs are sent and the others shuffle.
BROADCAST_PAIRS = 1_000_000
# A pair is frequent if it holds more than this share of the rows, so at most FREQUENT pairs are.
FREQUENT = 1000
# Stretches a worker remembers, and as many earlier ones.
KNOWN = 150_000

# A stretch ends before a space that follows a sign other than white space. No token of either vocabulary crosses such a place.
_SPACES = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_WHITE_BUT_SPACE = "\t-\r" + "".join(map(chr, _SPACES))
_WHITE = " " + _WHITE_BUT_SPACE
STRETCH = re.compile(f"[{_WHITE}]*[^{_WHITE}]+(?:[{_WHITE_BUT_SPACE}][{_WHITE}]*[^{_WHITE}]*)*|[{_WHITE}]+")


def _byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves, the others as code points from 256 on, in order."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or (0xA1 <= b <= 0xFF and b != 0xAD)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both vocabularies with the bytes of every token."""

    def __init__(self, byte_json: bytes, piece_model: bytes) -> None:
        spec = json.loads(byte_json)
        alphabet, vocabulary = _byte_alphabet(), spec["model"]["vocab"]
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocabulary.items()}
        self.bytes_a = {i: token for token, i in ranks.items()}
        merged = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        # Where ids follow the order of merges they serve as ranks, and the faster encoder gives the same ids.
        in_order = all(vocabulary["".join(m)] == 256 + i for i, m in enumerate(merged))
        self.plain = Tokenizer.from_str(byte_json.decode())
        self.plain.encode_special_tokens = True
        self.fast = tiktoken.Encoding("byte", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={}) if in_order else None

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)
        ]
        self.gap = self.pieces.piece_to_id("▁")
        self.length_a = np.zeros(max(self.bytes_a) + 1, np.int64)
        for i, token in self.bytes_a.items():
            self.length_a[i] = len(token)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Else whole texts are encoded at once.
        crossing = re.compile(f"[^{_WHITE}] ")
        both = chain(self.bytes_a.values(), self.bytes_b)
        self.divisible = not any(crossing.search(x.decode("utf-8", "replace")) for x in both)
        # What lately came up, and what did before that.
        self.known: dict[str, tuple | None] = {}
        self.earlier: dict[str, tuple | None] = {}

    def stretches(self, text: str) -> list[str]:
        """``text`` (which begins with a space) in parts that both tokenizers encode on their own."""
        return STRETCH.findall(text) if self.divisible else [text]

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B for texts that begin with a space, which B puts there by itself."""
        try:
            a = [self.fast.encode_ordinary(p) for p in parts] if self.fast else None
        except BaseException as stopped:  # the encoder's own panics are no Exception
            if isinstance(stopped, (KeyboardInterrupt, SystemExit, GeneratorExit)):
                raise
            a = None
        if a is None:
            a = [e.ids for e in self.plain.encode_batch(parts, add_special_tokens=False)]
        b = self.pieces.encode([p[1:] for p in parts], num_threads=1)
        return a, [ids if len(p) > 1 else [self.gap] for p, ids in zip(parts, b)]

    def _sound(self, a: list[list[int]], b: list[list[int]], raw: list[bytes]) -> list[bool]:
        """Whether the bytes of a part's tokens make up the part, for both."""
        whole = b"".join(raw)
        same = b"".join([self.bytes_a[i] for x in a for i in x]) == whole == b"".join([self.bytes_b[i] for x in b for i in x])
        if same and len(raw) == 1:
            return [True]
        size_a, size_b = self.length_a.tolist(), self.length_b.tolist()
        if same and all(
            sum([size_a[i] for i in x]) == len(r) == sum([size_b[i] for i in y]) for x, y, r in zip(a, b, raw)
        ):
            return [True] * len(raw)
        return [
            b"".join([self.bytes_a[i] for i in x]) == r == b"".join([self.bytes_b[i] for i in y]) for x, y, r in zip(a, b, raw)
        ]

    def align(self, parts: list[str]) -> list[tuple | None]:
        """For each part (number of A ids, number of B ids, its groups as text, its links); None where the bytes differ."""
        a, b = self.encode(parts)
        raw = [p.encode() for p in parts]
        sound = self._sound(a, b, raw)
        if not all(sound):
            a, b = [x for x, ok in zip(a, sound) if ok], [x for x, ok in zip(b, sound) if ok]
        ids_a, ids_b = np.array(list(chain.from_iterable(a)), np.int64), np.array(list(chain.from_iterable(b)), np.int64)
        ends_a, ends_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        # Parts end where both end, so one pass over all of them finds each part's own groups.
        _, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        links = ((ids_a[at_a] << 32) | ids_b[at_b]).tolist()
        text_a, text_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        groups, i, j = [], 0, 0
        for p, q in zip((at_a + 1).tolist(), (at_b + 1).tolist()):
            left = text_a[i] if p == i + 1 else ",".join(text_a[i:p])
            right = text_b[j] if q == j + 1 else ",".join(text_b[j:q])
            groups.append(f"{left}|{right}")
            i, j = p, q
        last = np.searchsorted(at_a, np.cumsum([len(x) for x in a]) - 1, "right").tolist()
        found, start, rows = [], 0, iter(zip(a, b, last))
        for ok in sound:
            if not ok:
                found.append(None)
                continue
            x, y, stop = next(rows)
            found.append((len(x), len(y), ";".join(groups[start:stop]), tuple(links[start:stop])))
            start = stop
        return found

    def aligned(self, texts: list[str]) -> Iterator[tuple | None]:
        """``align`` of whole texts, put together from their stretches; each different stretch is encoded once."""
        cut_up = [self.stretches(" " + t) for t in texts]
        if len(self.known) > KNOWN:
            self.earlier, self.known = self.known, {}
        known, new = self.known, []
        for s in set(chain.from_iterable(cut_up)):
            if s not in known:
                if s in self.earlier:
                    known[s] = self.earlier[s]
                else:
                    new.append(s)
        if new:
            known.update(zip(new, self.align(new)))
        for parts in cut_up:
            found = [known[s] for s in parts]
            if None in found:
                yield None
                continue
            n_a, n_b, groups, links = zip(*found)
            yield sum(n_a), sum(n_b), ";".join(groups), list(chain.from_iterable(links))


_loaded: dict[tuple[bytes, bytes], Tokenizers] = {}


def _tokenizers(byte_json: bytes, piece_model: bytes) -> Tokenizers:
    """Built once per worker process."""
    key = (byte_json, piece_model)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Tokenizers(byte_json, piece_model)
    return _loaded[key]


MEASURES = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def _measure(byte_json: bytes, piece_model: bytes):
    """Per distinct text its measures, and its different id pairs with how many links hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _tokenizers(byte_json, piece_model)
        for piece in pieces(batches):
            texts = piece.column("text").to_pylist()
            rows, pairs, held, at = [], [], [], [0]
            for found in both.aligned(texts):
                if found is None:
                    rows.append((0, 0, 0, 0, ""))
                    at.append(at[-1])
                    continue
                n_a, n_b, groups, links = found
                different, times = np.unique(np.array(links, np.int64), return_counts=True)
                pairs.append(different)
                held.append(times)
                at.append(at[-1] + len(different))
                rows.append((n_a, n_b, len(links), len(links), hashlib.sha256(groups.encode()).hexdigest()))
            flat, times = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (pairs, held))
            offsets = pa.array(np.array(at, np.int32))
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("text_id"),
                    piece.column("copies"),
                    pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary()),
                    *[pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                    pa.ListArray.from_arrays(offsets, pa.array(flat)),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                ],
                ["text_id", "copies", "digest", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "held"],
            )

    return run


def aligned_texts(docs: DataFrame, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE) -> DataFrame:
    """One row per different text that is neither null nor empty: text_id, copies, digest, its measures, its id pairs.

    Texts meet in a shuffle by the full text, so copies are one row before
    anything is encoded.
    """
    with open(byte_file, "rb") as one, open(piece_file, "rb") as two:
        step = _measure(one.read(), two.read())
    texts = docs.select(F.col("text").cast("string").alias("text")).filter("text <> ''")
    texts = texts.groupBy("text").agg(F.count(F.lit(1)).alias("copies")).withColumn("text_id", F.monotonically_increasing_id())
    kinds = f"text_id bigint, copies bigint, digest binary, {MEASURES}, pairs array<bigint>, held array<int>"
    return texts.mapInArrow(step, kinds)


def _pairs(aligned: DataFrame, *columns: str) -> DataFrame:
    """One row per text and different id pair, with the number of the text's links that hold it."""
    each = aligned.select(*columns, F.explode(F.arrays_zip("pairs", "held")).alias("p"))
    return each.select(*columns, F.col("p.pairs").alias("pair"), F.col("p.held").alias("held"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, pair, links, texts, best): the corpus-wide links of each id pair, copies counted, and whether b has no better partner."""
    counts = _pairs(aligned, "copies").groupBy("pair").agg(
        F.sum(F.col("held") * F.col("copies")).alias("links"), F.count(F.lit(1)).alias("texts")
    )
    a, b = F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b")
    counts = cut(counts.select(a, b, "*"), "pair_counts")
    # One row for each id of B: no more than its vocabulary has.
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    return counts.join(F.broadcast(most), "b").select("a", "b", "pair", "links", "texts", (F.col("links") == F.col("most")).alias("best"))


def _looked_up(each: DataFrame, counts: DataFrame) -> DataFrame:
    """``each`` with the counts of its pairs: sent to every task if few, else only the frequent ones are."""
    number, rows = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("texts"), F.lit(0))).first()
    wanted = counts.select("pair", "links", "best")
    if number <= BROADCAST_PAIRS:
        return each.join(F.broadcast(wanted), "pair")
    limit = max(1, rows // FREQUENT)
    often = counts.filter(F.col("texts") > limit).select("pair", "links", "best")
    seldom = counts.filter(F.col("texts") <= limit).select("pair", "links", "best")
    tried = each.join(F.broadcast(often), "pair", "left")
    hit = tried.filter("links is not null")
    return hit.unionByName(tried.filter("links is null").drop("links", "best").join(seldom, "pair"))


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.col(text).cast("string").cast("binary"), 256))


def align(docs: DataFrame, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE) -> DataFrame:
    """``doc_id`` of every row of ``docs`` with the measures of its text's alignment.

    A is the byte-level vocabulary over a space and the text, B the piece
    vocabulary over the text. Places where tokens of both end cut them into
    groups; the last A and B token of each group are a link. A pair of ids
    counts as many links as hold it in all documents.

    Equal texts are encoded and aligned once and count as often as they occur;
    measures return to the rows by the SHA-256 of the text. Encoding runs over
    stretches that neither tokenizer crosses, each different stretch once per
    batch. Null and empty texts, and texts whose token bytes do not make up a
    space and the text, have zeros and an empty digest. Repeated rows stay
    repeated, null ids stay null, other columns are ignored; an empty table
    gives no rows.
    """
    aligned = cut(aligned_texts(docs, byte_file, piece_file), "aligned")
    counts = cut(pair_counts(aligned), "best_pairs")
    each = _looked_up(_pairs(aligned, "text_id"), counts)
    held = F.col("held").cast("bigint")
    scored = each.groupBy("text_id").agg(
        F.sum(F.when(F.col("best"), held).otherwise(F.lit(0))).alias("n_best"), F.sum(held * F.col("links")).alias("count_sum")
    )
    measures = aligned.drop("copies", "pairs", "held").join(scored, "text_id", "left").drop("text_id")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _digest("text").alias("digest"))
    found = rows.join(measures, "digest", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return found.select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
