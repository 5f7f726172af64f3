"""Vector bin packing of tokenized texts into training sequences.

A sequence has three limits at once: tokens, segments and loss-bearing tokens. Pieces go to the
open sequence with the greatest dot product of what the piece needs and what the sequence has
left (both as shares of the limits). When no open sequence can take a piece, the fullest one is
topped up with the head of that piece and closed, so sequences close full. A sequence that has
reached its loss limit with tokens left waits for the loss-free head of a later piece, and a
document longer than a sequence fills that rest with its own. At the end of a
partition the open ones are poured together, and the last tokens are cut into sequences whose
lengths are powers of two, which need no padding.

Each partition of the input is packed by itself, in one pass and without a shuffle; a task holds
one Arrow batch, ``open_bins`` sequences and a bounded cache of words. A task that runs again
gives the same sequences, as its rows come from the same file split.

Edge cases: a null or empty text has the end token only; null ids are carried along; repeated
rows are packed one by one; a text longer than a sequence is cut; an empty table gives no rows.
"""

from __future__ import annotations

import codecs
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.tables import returning_memory

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, loss_tokens long"
)


class WordTokenizer:
    """Token ids of a text by way of its words.

    This tokenizer normalizes a text, cuts it into words (runs of letters, single digits, runs of
    other signs), drops white space and encodes each word by itself; the last id of a word is one
    of those that end a word. Ids of words, and of the runs between white space that hold them, are
    kept in two generations of bounded size. Texts in which the normalization depends on context, or
    that name a special token, are encoded whole.
    """

    #: Fixed value: how this vocabulary's tokenizer cuts words.
    WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: The same for lower-case ASCII and Latin letters; runs of letters, the most frequent, first.
    ASCII = re.compile("[a-z]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\x09-\x0D\x20a-z0-9]+")
    LATIN = re.compile(
        "'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff\u0101-\u017f]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|"
        "[^\x09-\x0D\x20\x85\xa0a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff\u0101-\u017f0-9\xb2\xb3\xb9\xbc-\xbe]+"
    )
    NOT_LATIN = re.compile("[^\t-\r -~\xa0-\u012f\u0131-\u017f\u2010-\u2027]|<\\|")
    #: What Unicode versions or context may treat differently, and special tokens.
    UNSURE = re.compile("[^\t-\r -~\xa0-\u012f\u0131-\u017f\u0410-\u044f\u2010-\u2027\u3041-\u3096\u4e00-\u9fff\uac00-\ud7a3]|<\\|")

    def __init__(self, path: str | None, most: int = 200_000):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        self.model, self.most = Tokenizer.from_file(str(path)), most
        # For words that are cut already, their bytes written as the vocabulary writes them; both
        # share one vocabulary.
        self.cut_words = Tokenizer(self.model.model)
        self.cut_words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        shown = dict(zip(others, range(256, 512), strict=False)) | {32: 32}  # spaces stay between words
        self.written = "".join(chr(shown.get(b, b)) for b in range(256))
        self.any_words = regex.compile(self.WORDS)
        vocabulary = self.model.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _written(self, words: list[str]) -> str:
        return codecs.charmap_decode(" ".join(words).encode(), "strict", self.written)[0]

    def _whole(self, text: str) -> bytes:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Each distinct run between ASCII white space is looked up once for all of them."""
        out: list[bytes | None] = [None] * len(texts)
        at, lowered = [], []
        for i, text in enumerate(texts):
            if text.isascii() and "<|" not in text:
                lowered.append(text.lower())
            elif not self.UNSURE.search(text):
                lowered.append(unicodedata.normalize("NFC", text).lower())
            else:
                out[i] = self._whole(text)
                continue
            at.append(i)
        runs = pc.ascii_split_whitespace(pa.array(lowered, pa.large_string()))
        coded = runs.values.dictionary_encode()
        known = self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        if known is None:
            return [self._whole(text) for text in texts]
        which = coded.indices.to_numpy()
        size = np.array([len(x) // 4 for x in known], np.int64)
        count = size[which]
        stops = np.concatenate([[0], np.cumsum(count)])
        # The id at place k of run r stands at place k of its run in the ids of all distinct ones.
        shift = (np.cumsum(size) - size)[which] - stops[:-1]
        ids = np.frombuffer(b"".join(known), "<u4")[np.repeat(shift, count) + np.arange(stops[-1])]
        bounds = stops[runs.offsets.to_numpy()].tolist()
        for i, start, stop in zip(at, bounds, bounds[1:], strict=False):
            out[i] = ids[start:stop].tobytes()
        return out

    def _ids_of(self, runs: list[str]) -> list[bytes] | None:
        """The ids of each run of signs; none if the vocabulary cuts a word in another way."""
        known, old = self.young, self.old
        lacking = [r for r in runs if r not in known]
        words, cuts = [], {}
        for r in lacking:
            if r in old:
                known[r] = old[r]
            elif r.isalpha():
                words.append(r)
            else:
                cut = self.ASCII if r.isascii() else self.any_words if self.NOT_LATIN.search(r) else self.LATIN
                cuts[r] = cut.findall(r)
        new = []
        for w in set(words).union(*cuts.values()):
            if w in old:
                known[w] = old[w]
            elif w not in known:
                new.append(w)
        if new:
            ids = np.array(self.cut_words.encode_batch_fast([self._written(new)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(new):
                return None
            data, start = ids.tobytes(), 0
            for w, stop in zip(new, (4 * stops).tolist(), strict=True):
                known[w] = data[start:stop]
                start = stop
        for r, parts in cuts.items():
            known[r] = b"".join([known[w] for w in parts])
        found = [known[r] for r in runs]
        if len(known) > self.most:
            self.young, self.old = {}, known
        return found


@dataclass
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


@dataclass
class Piece:
    doc_id: int | None
    start: int
    ids: memoryview
    doc_tokens: int
    prompt: int

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    @property
    def free(self) -> int:
        """Tokens at its head that bear no loss."""
        return min(self.length, max(0, self.prompt - self.start))

    @property
    def loss(self) -> int:
        return self.length - self.free

    def cut(self, n: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.start, self.ids[: 4 * n], self.doc_tokens, self.prompt)
        return head, Piece(self.doc_id, self.start + n, self.ids[4 * n :], self.doc_tokens, self.prompt)

    def most(self, tokens: int, loss: int) -> int:
        """Tokens of the head that fit."""
        return min(tokens, self.length, self.free + loss)


@dataclass
class Packer:
    """Packs pieces into sequences; ``closed`` gets finished lists of pieces."""

    limits: Limits
    open_bins: int = 32
    closed: list = field(default_factory=list)

    def __post_init__(self):
        limits = self.limits
        if min(limits.tokens, limits.segments, limits.loss) < 1:
            raise ValueError("Limits must be positive")
        self.cap = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.left = np.zeros((self.open_bins, 3))
        self.bins: list[list[Piece] | None] = [None] * self.open_bins

    def add(self, piece: Piece) -> None:
        tokens, loss = self.limits.tokens, self.limits.loss
        rest = tokens - loss
        if 0 < rest <= piece.free and piece.loss > loss and self.limits.segments > 1:
            free, piece = piece.cut(piece.free)
            while rest <= free.length and loss <= piece.length:
                head, free = free.cut(rest)
                body, piece = piece.cut(loss)
                self.closed.append([head, body])
            self._add(free)
        self._add(piece)

    def _add(self, piece: Piece) -> None:
        while piece.length:
            if piece.length > self.cap[0] or piece.loss > self.cap[2]:
                head, piece = piece.cut(piece.most(int(self.cap[0]), int(self.cap[2])))
                self._place(head)
            else:
                self._place(piece)
                return

    def _place(self, piece: Piece) -> None:
        while True:
            waiting = np.flatnonzero((self.left[:, 0] > 0) & (self.left[:, 1] >= 1) & (self.left[:, 2] == 0)) if piece.free else ()
            if len(waiting):
                at = int(waiting[np.argmin(self.left[waiting, 0])])
                n = min(piece.free, int(self.left[at, 0]))
                head, piece = piece.cut(n)
                self.bins[at].append(head)
                self.left[at] -= [n, 1, 0]
                if self.left[at, 0] == 0:
                    self._close(at)
                if not piece.length:
                    return
                continue
            need = np.array([piece.length, 1, piece.loss], float)
            if need[0] == self.cap[0]:
                self.closed.append([piece])
                return
            fits = np.flatnonzero((self.left >= need).all(axis=1))
            if len(fits):
                at = fits[np.argmax((self.left[fits] / self.cap) @ (need / self.cap))]
            elif None in self.bins:
                at = self.bins.index(None)
                self.bins[at], self.left[at] = [], self.cap
            else:
                most = np.minimum(np.minimum(self.left[:, 0], piece.length), piece.free + self.left[:, 2]) * (self.left[:, 1] >= 1)
                # The least padding, then the fewest tokens left.
                at = int(np.lexsort((self.left[:, 0], self.left[:, 0] - most))[0])
                n = int(most[at])
                if n:
                    head, piece = piece.cut(n)
                    self.bins[at].append(head)
                self._close(at)
                continue
            self.bins[at].append(piece)
            self.left[at] -= need
            if self.left[at, 0] == 0:
                self._close(at)
            return

    def _close(self, at: int) -> None:
        self.closed.append(self.bins[at])
        self.bins[at], self.left[at] = None, 0

    def finish(self) -> None:
        """Pours the open sequences together; what is left over goes to powers of two."""
        pieces = [p for b in self.bins if b for p in b]
        self.bins = [None] * self.open_bins
        rest = sum(p.length for p in pieces)
        while pieces:
            room = int(self.cap[0]) if rest >= self.cap[0] else 1 << (rest.bit_length() - 1)
            loss, bin_ = int(self.cap[2]), []
            while room and len(bin_) < self.limits.segments:
                i = next((i for i, p in enumerate(pieces) if p.most(room, loss)), None)
                if i is None:
                    break
                n = pieces[i].most(room, loss)
                head, tail = pieces[i].cut(n)
                bin_.append(head)
                pieces[i : i + 1] = [tail] if tail.length else []
                room, loss, rest = room - n, loss - head.loss, rest - n
            self.closed.append(bin_)


def _rows(closed: list, first: int) -> pa.RecordBatch:
    out = []
    for i, pieces in enumerate(closed):
        offset = 0
        for p in pieces:
            out.append((p.doc_id, p.start, p.length, zlib.crc32(p.ids), p.doc_tokens, first + i, offset, p.loss))
            offset += p.length
    columns = zip(*out, strict=True) if out else [[]] * 8
    names = [x.split(" ")[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names)


_TOKENIZERS: dict[str | None, WordTokenizer] = {}

#: Code points of the texts that are encoded together; a longer text goes by itself.
TOGETHER = 2_000_000


def _encoded(tokenizer: WordTokenizer, texts: pa.Array) -> Iterator[bytes]:
    """The ids of each text, in order."""
    held, size = [], 0
    for text in texts:
        x = text.as_py()
        if held and size + len(x) > TOGETHER:
            yield from tokenizer.encode_all(held)
            held, size = [], 0
        held.append(x)
        size += len(x)
    yield from tokenizer.encode_all(held)


def pack_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    limits: Limits = Limits(),  # noqa: B008
    end_id: int = 1,
    prompt_share: float = 0.0,
    tokenizer_path: str | None = None,
) -> DataFrame:
    """One row per piece: document, place in it, checksum of its ids, sequence and offset there.

    The first ``prompt_share`` of a document's ids bears no loss. ``tokenizer_path`` names the
    vocabulary file on the executors; by default that of the installed vocabulary package.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _TOKENIZERS:
            _TOKENIZERS[tokenizer_path] = WordTokenizer(tokenizer_path)
        tokenizer, packer = _TOKENIZERS[tokenizer_path], Packer(limits)
        end, next_id = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId() << 40
        for batch in batches:
            for doc_id, found in zip(batch.column(0).to_pylist(), _encoded(tokenizer, batch.column(1)), strict=True):
                ids = memoryview(found + end)
                packer.add(Piece(doc_id, 0, ids, len(ids) // 4, int(prompt_share * (len(ids) // 4))))
                if len(packer.closed) >= 1000:
                    yield _rows(packer.closed, next_id)
                    next_id, packer.closed = next_id + len(packer.closed), []
        packer.finish()
        yield _rows(packer.closed, next_id)

    texts = docs.select(
        F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("txt")
    )
    return texts.mapInArrow(returning_memory(run), SCHEMA)
