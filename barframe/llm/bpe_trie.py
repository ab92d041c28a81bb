"""BPE encoding and decoding by a prefix-sharing trie.

The distinct words of a task are walked in sorted order, which is a depth-first walk of their trie: the path of the
current word is kept as a stack, and a word pops only what it does not share with the word before it. Every prefix
carries one state, its *last token*: the encoding of a prefix is the encoding of what stands before its last token
followed by that token, so one token per trie node describes the encodings of all prefixes, and a shared prefix is
computed once. A token ending at a node is that state exactly if it is *compatible* with the state of the node where
it begins, that is, if merging by rank would leave the border between the two alone.

Python workers encode; Spark splits the documents. There is no shuffle. A worker's word table is bounded
(``MAX_WORDS``, ``MAX_PIECES``) and forgets what has not been used for long, which changes the time taken and never the ids.
"""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Words (of texts with odd characters) and pieces that a worker remembers in each of two generations.
MAX_WORDS = 100_000
MAX_PIECES = 450_000
# Characters of texts whose words share one trie, and rows that a task returns at once.
RUN_CHARS = 1_000_000
BATCH_ROWS = 500
WORD_END = "</w>"


class TrieBpe:
    """Encoder for a BPE vocabulary with word-end units, given as a ``tokenizers`` JSON file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.longest = max(map(len, self.vocab))
        # Token id -> (rank, left id, right id); units without a merge have none.
        self.made: dict[int, tuple[int, int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}  # (left id, right id) -> rank
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            ids = self.vocab[left], self.vocab[right]
            self.made[self.vocab[left + right]] = (rank, *ids)
            self.joined[ids] = rank
        self.text = {i: t for t, i in self.vocab.items()}
        self.units = {i: len(t) - len(WORD_END) + 1 if t.endswith(WORD_END) and len(t) > len(WORD_END) else len(t)
                      for t, i in self.vocab.items()}
        for t in spec["added_tokens"]:
            self.text[t["id"]] = t["content"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.fits: dict[tuple[int, int], bool] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging by rank leaves token ``a`` followed by token ``b`` as these two tokens.

        The units beside the border are those on the right edge of a's merge tree and on the left edge of b's. A pair
        across the border would be merged at the moment both stand there, if its rank comes before the merges that
        take either of them away (on equal rank the one further left goes first).
        """
        key = a, b
        known = self.fits.get(key)
        if known is None:
            known = self.fits[key] = self._border_holds(a, b)
        return known

    def _border_holds(self, a: int, b: int) -> bool:
        left, right = self._edge(a, 2), self._edge(b, 1)
        i = j = 0
        while True:
            (x, x_gone), (y, y_gone) = left[i], right[j]
            rank = self.joined.get((x, y))
            # x's own merge stands to the left of the border pair, so it wins a tie; y's loses it.
            if rank is not None and rank < x_gone and rank <= y_gone:
                return False
            if i + 1 == len(left) and j + 1 == len(right):
                return True
            if j + 1 == len(right) or (i + 1 < len(left) and x_gone <= y_gone):
                i += 1
            else:
                j += 1

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens on one edge of a merge tree from the unit up, each with the rank of the merge that absorbs it."""
        found, gone = [], float("inf")
        while True:
            found.append((token, gone))
            made = self.made.get(token)
            if made is None:
                return found[::-1]
            gone, token = made[0], made[side]

    def encode_pieces(self, pieces: list[str]) -> dict[str, list[int]]:
        """Ids of distinct pieces, given as byte-level units."""
        out: dict[str, list[int]] = {}
        vocab, units, longest, fit = self.vocab, self.units, self.longest, self.compatible
        before, state = "", []  # state[d]: last token of the first d + 1 units of the current path
        for piece in sorted(pieces):
            n, same = len(piece), 0
            top = min(n - 1, len(state))
            while same < top and piece[same] == before[same]:
                same += 1
            del state[same:]
            for end in range(same + 1, n):
                for begin in range(max(0, end - longest), end):
                    t = vocab.get(piece[begin:end])
                    if t is not None and (begin == 0 or fit(state[begin - 1], t)):
                        state.append(t)
                        break
                else:
                    raise ValueError(f"no token for a prefix of {piece!r}")
            whole = piece + WORD_END
            for begin in range(max(0, n - longest), n):
                t = vocab.get(whole[begin:])
                if t is not None and (begin == 0 or fit(state[begin - 1], t)):
                    ids, at = [t], begin
                    break
            else:
                raise ValueError(f"no token for {piece!r}")
            while at > 0:
                t = state[at - 1]
                ids.append(t)
                at -= units[t]
            out[piece] = ids[::-1]
            before = piece
        return out

    def pieces(self, word: str) -> list[str]:
        """The byte-level pieces of any word, by the vocabulary file's own normaliser and splitter."""
        return [p for p, _ in self.lib.pre_tokenizer.pre_tokenize_str(self.lib.normalizer.normalize_str(word))]


def _byte_units() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself where it is printable
    Latin-1, else the next free one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)]


_UNIT = _byte_units()

# The splitter's pattern, fixed by the vocabulary file, on lower-case ASCII and Latin-1 letters; and the words that
# hold nothing else, on which the file's normaliser does no more than lower-casing.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PLAIN_TEXT = re.compile(r"[ \t\n\r!-~À-ÖØ-öø-ÿ]*")


def plain_pieces(word: str) -> list[str] | None:
    """The pieces of a word of ASCII signs and Latin-1 letters without special tokens; None for any other word."""
    return _PIECE.findall(word.lower()) if _PLAIN.fullmatch(word) and "<|" not in word else None


def text_pieces(text: str) -> list[str] | None:
    """The pieces of a whole text of such words between plain white space, which no piece crosses; None for any other."""
    return _PIECE.findall(text.lower()) if _PLAIN_TEXT.fullmatch(text) and "<|" not in text else None


def split_words(text: str) -> list[str]:
    """Cut at the plain white space that the normaliser turns to blanks anyway; rarer space stays inside a word."""
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


class Memory(dict):
    """What a worker has computed, by key. When it is full the entries become the old generation, from which those
    still used are taken back; the generation before is forgotten."""

    def __init__(self, limit: int):
        super().__init__()
        self.old: dict = {}
        self.limit = limit

    def rotate(self) -> None:
        """Make the entries the old generation if there are too many of them."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()

    def new_keys(self, keys: set) -> list:
        """The keys that neither generation has; those of the old one are taken back."""
        self.rotate()
        return self.unknown(keys.difference(self))

    def unknown(self, keys) -> list:
        out, old = [], self.old
        for k in keys:
            v = old.get(k)
            if v is None:
                out.append(k)
            else:
                self[k] = v
        return out


class WordMemory:
    """Turns texts into values by words and pieces that it remembers. Subclasses say what a value is, and how many
    words and pieces a generation may hold."""

    limits = (MAX_WORDS, MAX_PIECES)

    def __init__(self):
        self.words, self.known = Memory(self.limits[0]), Memory(self.limits[1])

    def of_pieces(self, pieces: list[str]):
        raise NotImplementedError

    def of_odd_words(self, words: list[str]):
        raise NotImplementedError

    def joined(self, values: list):
        raise NotImplementedError

    def learn(self, words: set[str]) -> None:
        cut, odd = {}, []
        new = self.words.new_keys(words)
        self.words[""] = self.joined([])
        for w in new:
            ps = plain_pieces(w)
            if ps is None:
                odd.append(w)
            else:
                cut[w] = ps
        known = self.known
        known.update(self.of_pieces(known.new_keys({p for ps in cut.values() for p in ps})))
        self.words.update(self.of_odd_words(odd))
        for w, ps in cut.items():
            self.words[w] = known[ps[0]] if len(ps) == 1 else self.joined([known[p] for p in ps])

    def encode(self, texts: list[str]) -> Iterator:
        """The value of each text. What a run of texts has of new pieces (or words, in texts with odd characters) is
        learned together; every occurrence of a piece is looked up once, and what was new once more."""
        for run in _runs(texts):
            # Encoding makes no cycles; looking for them in the large tables would cost more than it does.
            gc.disable()
            try:
                out, again, new = [None] * len(run), [], set()
                self.known.rotate()
                get = self.known.get
                odd = []
                for i, t in enumerate(run):
                    pieces = text_pieces(t)
                    if pieces is None:
                        odd.append(i)
                        continue
                    values = list(map(get, pieces))
                    try:
                        out[i] = self.joined(values)
                    except TypeError:  # a piece not known
                        gaps = [(k, pieces[k]) for k, v in enumerate(values) if v is None]
                        again.append((i, values, gaps))
                        new.update([p for _, p in gaps])
                self.known.update(self.of_pieces(self.known.unknown(new)))
                for i, values, gaps in again:
                    for k, p in gaps:
                        values[k] = get(p)
                    out[i] = self.joined(values)
                if odd:
                    parts = [split_words(run[i]) for i in odd]
                    words = set().union(*parts)
                    words.discard("")
                    self.learn(words)
                    value = self.words.__getitem__
                    for i, ws in zip(odd, parts):
                        out[i] = self.joined(list(map(value, ws)))
            finally:
                gc.enable()
            yield from out


class TrieWorker(WordMemory):
    """Values are (ids as little-endian 32-bit integers, the text they decode to), by the trie; they are larger than
    ids alone, so fewer are held."""

    limits = (50_000, 200_000)

    def __init__(self, path: str):
        super().__init__()
        self.bpe = TrieBpe(path)
        self.raw = {i: i.to_bytes(4, "little") for i in self.bpe.text}

    def _value(self, ids: list[int]) -> tuple[bytes, str]:
        return b"".join([self.raw[i] for i in ids]), " ".join([self.bpe.text[i] for i in ids])

    def of_pieces(self, pieces: list[str]):
        units = {"".join([_UNIT[b] for b in p.encode()]): p for p in pieces}
        return ((units[u], self._value(ids)) for u, ids in self.bpe.encode_pieces(list(units)).items())

    def of_odd_words(self, words: list[str]):
        cut = {}
        for w in words:
            if "<|" in w and any(s in w for s in self.bpe.special):
                yield w, self._value(self.bpe.lib.encode(w, add_special_tokens=False).ids)
            else:
                cut[w] = self.bpe.pieces(w)
        known = self.bpe.encode_pieces(list({p for ps in cut.values() for p in ps}))
        for w, ps in cut.items():
            yield w, self._value([i for p in ps for i in known[p]])

    def joined(self, values: list) -> tuple[bytes, str]:
        return b"".join([x for x, _ in values]), " ".join([y for _, y in values if y])


def _runs(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts of about ``RUN_CHARS`` characters together."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= RUN_CHARS:
            yield run
            run, size = [], 0
    if run:
        yield run


_WORKER: dict = {}


def worker(kind, path: str):
    """This process's encoder of a kind for a vocabulary file; one used before is dropped."""
    if (kind, path) not in _WORKER:
        _WORKER.clear()
        _WORKER[kind, path] = kind(path)
    return _WORKER[kind, path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Encode whole texts and decode them again: (id, ids_le binary, decoded string), one row per input row.

    ``ids_le`` holds the ids as little-endian unsigned 32-bit integers. Null text: as an empty one (no ids, empty
    decoded text). Repeated rows give repeated results; a null id stays null; other columns are not read, so their
    names cannot clash; an empty table gives an empty one. ``path`` must be readable on every executor.
    """
    path = path or default_path()

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, BATCH_ROWS):
                part = b.slice(k, BATCH_ROWS)
                found = list(worker(TrieWorker, path).encode([t or "" for t in part.column(1).to_pylist()]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x for x, _ in found], pa.binary()),
                     pa.array([y for _, y in found], pa.string())], names=["id", "ids_le", "decoded"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids_le binary, decoded string").withColumnRenamed("id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return encoded.selectExpr(
        f"`{id_col}`", "cast(length(ids_le) div 4 as bigint) as n_tokens", "sha2(ids_le, 256) as ids_sha256",
        "sha2(cast(decoded as binary), 256) as decoded_sha256")
