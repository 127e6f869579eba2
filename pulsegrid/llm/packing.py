"""Packing of token sequences by the dot-product heuristic of vector bin packing."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import release, slices

CAPACITY = 1024
MAX_SEGMENTS = 64
#: Loss-bearing tokens of a sequence, and the share of a document's tokens, at its head, that bear no loss (its prompt).
MAX_LOSS = 896
PROMPT_SHARE = 0.25
POOL = 256
#: Bytes of text whose parts are encoded together, each once.
TOGETHER = 2 << 20

OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("token_ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("loss_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


#: Texts that aren't cut at all: a space before white space; the mark that stands for a head below.
_WHOLE = re.compile(r" \s|\x03")
#: Texts that aren't cut at line ends: longer runs of white space, and those that end a text.
_LINES = re.compile(r"\s\s\s|\n[^\S\n]|\s\s\Z")
#: Marks of punctuation that can end a part, and parts of Latin letters, up to U+024F, with one or none.
_MARKS = ",.;:!?"
_WORD = rf"^\n?[A-Za-zªµºÀ-ÖØ-öø-ɏ]+[{_MARKS}]?$"


#: How a byte-level vocabulary writes bytes: those that print as themselves, the others from 256 on, in order.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_CHARACTERS = {b: b if b in _PRINTED else 256 + sum(x not in _PRINTED for x in range(b)) for b in range(256)}


#: The same for bytes beyond ASCII; others stay.
_HIGH = np.array([_CHARACTERS[b] if b > 127 else b for b in range(256)], "<u4")
_SPACE, _LINE = chr(_CHARACTERS[32]), chr(_CHARACTERS[10])


#: ASCII white space other than space and line end.
_OTHER = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"


def _plain(text: str) -> bool:
    """Whether a text has no white space and marks but single spaces and line ends; most have not."""
    return text.isascii() and "  " not in text and " \n" not in text and not any(c in text for c in _OTHER + "\x03")


class Encoder:
    """Ids of a byte-level BPE vocabulary, as little-endian unsigned 32-bit integers in bytes.

    Where one space or line end stands between other characters a pre-token begins. Texts are cut there, and each distinct
    part is encoded once in a call. Most parts are letters and maybe a mark of punctuation, whose pre-tokens are known: these
    are written as the vocabulary writes them, and only the merges are left to do.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: The same merges for pre-tokens that stand between spaces.
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        #: Bytes of each id: a byte-level vocabulary writes each byte as one character.
        self.width = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.width[i] = len(token)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def stops(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray | None:
        """How many ids cover each first part, given the bytes of the parts in turn; None if an id reaches over an end."""
        ends, covered = np.cumsum(lengths), np.cumsum(self.width[ids])
        at = np.searchsorted(covered, ends)
        return at + 1 if len(ids) and at[-1] == len(ids) - 1 and np.array_equal(covered[at], ends) else None

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of words that each begin a pre-token: many are encoded as one text, which is cut by the bytes of its ids."""
        out: list[bytes] = []
        for k in range(0, len(words), 256):
            part = words[k : k + 256]
            ids = np.asarray(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = self.stops(ids, np.array([len(w.encode("utf-8", "surrogatepass")) for w in part]))
            if stops is not None:
                raw, stops = ids.tobytes(), (4 * stops).tolist()
                out += [raw[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]
            else:
                out += self.whole(part)
        return out

    def lettered(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts that are _WORD, a few thousand encoded as one text, and the number of each one's ids."""
        out, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for begin in range(0, len(parts), 4096):
            some = parts.slice(begin, 4096)
            lengths = pc.binary_length(some).to_numpy() + ~pc.starts_with(some, "\n").to_numpy(zero_copy_only=False)
            text = " ".join(some.to_numpy(zero_copy_only=False))
            if not text.isascii():
                text = _HIGH[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")
            text = _SPACE + text.replace(" ", " " + _SPACE)
            text = text.replace(_SPACE + "\n", _LINE + " ")
            for mark in _MARKS:
                text = text.replace(mark, " " + mark)
            ids = np.asarray(self.merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = self.stops(ids, lengths)
            if stops is None:
                raise ValueError("the vocabulary isn't a byte-level one")
            out.append(ids)
            sizes.append(np.diff(stops, prepend=0))
        return np.concatenate(out), np.concatenate(sizes)

    def cut(self, text: str) -> str | None:
        """A text with a space before every part: line ends begin parts, \\x03 the head."""
        # Most others have but single spaces and line ends too, between words.
        plain = _plain(text) or "\x03" not in text and text.split() == text.replace("\n", " ").split(" ")
        if not plain and _WHOLE.search(text) or any(s in text for s in self.special):
            return None
        odd = "\n\n\n" in text or "\n " in text or text.endswith("\n\n") if plain else _LINES.search(text)
        return "\x03" + (text if odd else text.replace("\n", " \n"))

    def of_parts(self, parts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Lists of ids, the number of each one's ids, and which of them is that of each of the distinct parts."""
        letters = pc.match_substring_regex(parts, _WORD).to_numpy(zero_copy_only=False)
        heads, others, found, texts = [], [], [], []
        rest = parts.filter(pa.array(~letters)).to_numpy(zero_copy_only=False).tolist()
        for i, w in zip(np.flatnonzero(~letters).tolist(), rest, strict=True):
            if w[:1] == "\x03":
                heads.append(i)
                found.append(w[1:])
            else:
                others.append(i)
                texts.append(w if w[:1] == "\n" else " " + w)
        ids, sizes = self.lettered(parts.filter(pa.array(letters)))
        more = self.whole(found) + self.words(texts)
        sizes = np.append(sizes, np.fromiter(map(len, more), np.int64, len(more)) // 4)
        ids = np.append(ids, np.frombuffer(b"".join(more), "<u4"))
        place = np.zeros(len(parts), np.int64)
        place[np.append(np.flatnonzero(letters), np.array(heads + others, np.int64))] = np.arange(len(parts))
        return pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes))), pa.array(ids)), sizes, place

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.cut(t) for t in texts]
        odd = iter(self.whole([t for t, c in zip(texts, cut, strict=True) if c is None]))
        lists = pc.split_pattern(pa.array([c for c in cut if c is not None], pa.large_string()), " ")
        flat = lists.flatten().dictionary_encode()
        if not len(flat):
            return list(odd)
        table, sizes, place = self.of_parts(flat.dictionary)
        at = place[flat.indices.to_numpy()]
        every = table.take(pa.array(at)).flatten().to_numpy()
        # Where each text ends, in parts and then in ids.
        ends = np.append(0, np.cumsum(sizes[at]))[lists.offsets.to_numpy()]
        raw, stops = every.astype("<u4", copy=False).tobytes(), (4 * ends).tolist()
        known = iter([raw[a:b] for a, b in zip(stops, stops[1:])])
        return [next(odd) if c is None else next(known) for c in cut]


class Packer:
    """Fills one sequence after another from a pool of pieces.

    The next piece is the one with the greatest dot product between its demands (tokens, one segment, loss tokens; each
    as a share of its limit) and what the sequence has left. A piece demands what of it a whole sequence can hold. If
    none fits, the best one is cut to fill what is left. A sequence that a limit closes before it is full gives back what
    it has beyond a power of two, so that it needs no padding.
    """

    def __init__(self, capacity: int, max_segments: int, max_loss: int, first_sequence: int):
        self.capacity, self.max_segments, self.max_loss = capacity, max_segments, max_loss
        self.next_sequence = first_sequence
        self.pieces: list = []  # [doc_id, start of what is left, all ids, tokens, first loss-bearing token, end]
        self.rows: list[tuple] = []

    @staticmethod
    def loss(start: int, length: int, loss_from: int) -> int:
        return max(0, start + length - max(start, loss_from))

    def fitting(self, start: int, length: int, loss_from: int, tokens: int, loss: int) -> int:
        """The longest prefix of what is left of a piece within both limits."""
        length = min(length, tokens)
        return length if self.loss(start, length, loss_from) <= loss else max(0, loss_from - start) + loss

    def add(self, doc_id, ids: bytes, loss_tokens: int) -> None:
        total = len(ids) // 4
        loss_from = total - min(total, max(0, loss_tokens))
        # What a sequence can't hold whole is cut where its loss begins: the parts fill up different sequences best.
        cuts = [0, loss_from, total] if total > self.capacity and 0 < loss_from < total else [0, total]
        self.pieces += [[doc_id, a, ids, total, loss_from, b] for a, b in zip(cuts, cuts[1:])]

    def _demand(self, p) -> tuple[int, int]:
        take = self.fitting(p[1], p[5] - p[1], p[4], self.capacity, self.max_loss)
        return take, self.loss(p[1], take, p[4])

    def pack(self, leave: int, last: bool = False) -> None:
        """Fill sequences until at most ``leave`` pieces are in the pool, or too few tokens to fill one more."""
        if not self.pieces or (len(self.pieces) <= leave and not last):
            return
        need = np.array([self._demand(p) for p in self.pieces], np.int64)
        length, loss = need[:, 0].copy(), need[:, 1].copy()
        live = len(length)
        left_over = sum(p[5] - p[1] for p in self.pieces)
        while live and (last or (live > leave and left_over >= self.capacity)):
            tokens, loss_left = self.capacity, self.max_loss
            if left_over < self.capacity:  # the rest, in sequences of powers of two
                tokens = 1 << (left_over.bit_length() - 1)
            room, chosen = tokens, []
            while tokens and len(chosen) < self.max_segments and live:
                score = length * (tokens / self.capacity**2) + loss * (loss_left / self.max_loss**2)
                score[length == 0] = -1
                fits = np.where((length <= tokens) & (loss <= loss_left), score, -1)
                i = int(fits.argmax())
                if fits[i] < 0:
                    # Of those that must be cut, one that gives something.
                    order = np.argsort(-score, kind="stable")
                    order = order[score[order] >= 0]
                    i = next((int(j) for j in order if self._take(j, tokens, loss_left)), -1)
                    if i < 0:
                        break
                take = self._take(i, tokens, loss_left)
                p = self.pieces[i]
                chosen.append((i, p[1], take))
                tokens -= take
                loss_left -= self.loss(p[1], take, p[4])
                p[1] += take
                length[i], loss[i] = self._demand(p)
                live -= p[1] == p[5]
            used = room - tokens
            keep = used if used == self.capacity else 1 << (used.bit_length() - 1)
            offset = 0
            for i, start, take in chosen:
                doc_id, at, ids, total, loss_from, end = p = self.pieces[i]
                n = min(take, keep - offset)
                if n:
                    self.rows.append((doc_id, start, n, ids[4 * start : 4 * (start + n)], total, self.loss(start, n, loss_from), self.next_sequence, offset))
                    offset += n
                if n < take:  # given back; pieces of one document in a sequence stand in order, so the first cut counts
                    live += at == end
                    p[1] = min(at, start + n)
                    length[i], loss[i] = self._demand(p)
            left_over -= keep
            self.next_sequence += 1
        self.pieces = [p for p in self.pieces if p[1] < p[5]]

    def _take(self, i: int, tokens: int, loss_left: int) -> int:
        p = self.pieces[i]
        return self.fitting(p[1], p[5] - p[1], p[4], tokens, loss_left)

    def drain(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), OUT, strict=True)] if rows else [pa.array([], t.type) for t in OUT],
            schema=OUT,
        )


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    loss_col: str | None = None,
    prompt_share: float = 0.0,
    end_id: int = 0,
    capacity: int = CAPACITY,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int | None = None,
    pool: int = POOL,
) -> DataFrame:
    """Tokenise texts and pack them into sequences under limits on tokens, segments and loss-bearing tokens.

    One row per piece: doc_id, start, length, token_ids (little-endian unsigned 32-bit integers), doc_tokens (with
    ``end_id``), loss_tokens, sequence_id, offset. ``loss_col`` counts the last tokens of a document that bear loss;
    without it all do but the first ``prompt_share`` of them. Each task packs the rows of its own input split, so
    nothing is shuffled and no sequence needs another task. A sequence that isn't full has a power of two of tokens: a
    task's last few, and those that the limits on segments or loss close early.

    A null text is empty and gives ``end_id`` alone; a null id stays null; repeated rows are packed each for itself; of
    pieces with equal scores the one that came first is taken; an empty table gives no rows; other columns are ignored
    whatever their names.
    """
    max_loss = max_loss or capacity
    loss = F.col(loss_col).cast("long") if loss_col else F.lit(None).cast("long")
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), loss.alias("loss")
    )

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Encoder(vocabulary)
        packer = Packer(capacity, max_segments, max_loss, TaskContext.get().partitionId() << 32)
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            for part in slices(batch, 1, TOGETHER):
                doc_id, text, loss_tokens = (c.to_pylist() for c in part.columns)
                for d, ids, n in zip(doc_id, encoder.encode([t or "" for t in text]), loss_tokens, strict=True):
                    ids += end
                    total = len(ids) // 4
                    packer.add(d, ids, total - int(total * prompt_share) if n is None else n)
                    if len(packer.pieces) >= pool:
                        packer.pack(pool // 2)
                if packer.rows:
                    yield packer.drain()
        packer.pack(0, last=True)
        if packer.rows:
            yield packer.drain()
        del encoder, packer
        release()

    schema = "doc_id long, start long, length long, token_ids binary, doc_tokens long, loss_tokens long, sequence_id long, offset long"
    return source.mapInArrow(run, schema)
