"""Token ids and counts of whole texts, by encoding each distinct chunk of a text once per worker.

The tokenizers used here never merge across white space, so the ids of a text are the ids of its chunks in a
row. Chunks repeat, whole texts seldom do: a worker keeps the ids of the chunks it has seen in two generations
of bounded size, and asks the tokenizer library only for new ones, many in one call with a special token between
them. Where a text does not fit the cut, the library encodes the text as a whole.

``WORDS``: lower-casing tokenizer that drops white space; a chunk is a run of other characters. Texts in Latin
letters need no chunks: ``tiktoken`` encodes them by ``WordRanks``.
``SPACED``: byte-level tokenizer in which one blank belongs to the word after it.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402

WORDS, SPACED, WHOLE = "words", "spaced", "whole"
GENERATION = 250_000
BATCH = 512

#: Latin-1 capitals to small letters; the same for one character at a time.
_SMALL = bytes(c + 32 if 65 <= c <= 90 or (0xC0 <= c <= 0xDE and c != 0xD7) else c for c in range(256))
_BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WORD_CHUNKS = re.compile(r"[^ \t-\r]+")
_SPACED_CHUNKS = re.compile(f" ?[^{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]")
#: What the cut at single blanks and line ends cannot take: three in a row, two at the end, other white space.
_ODD_BLANKS = re.compile(rb"[ \n]{3}|[ \n]{2}\Z|[\t\r\x0b\x0c\x1c-\x1f\x85\xa0]")

# What the word tokenizer does before it merges, and the byte-level alphabet, which writes printable bytes as themselves and the
# others as the characters from U+0100 on.
_WORD_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_ALPHABET = {b: chr(b) for b in _PRINTABLE} | {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}

#: Beyond Latin letters up to U+017F and common punctuation, the library tells classes, small letters and compositions.
_NOT_LATIN = re.compile("[^\0-\u012f\u0131-\u017f\u2010-\u2027\u2030-\u205e\u20ac]")
#: The same split for the others, in lower case.
_LETTERS, _NUMBERS, _SPACES = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\\t-\\r \x85\xa0"
_WORD_PIECES = re.compile(f"'(?:[stmd]|re|ve|ll)|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")
_SPACE = re.compile(f"[{_SPACES}]")
PART = 1_000_000


class WordRanks:
    """A word tokenizer run by ``tiktoken``, without a cache, for texts in Latin letters.

    ``tiktoken`` merges the neighbours whose joint bytes rank lowest. A blank ends every word here, and merges of a byte with it come before all others;
    so the last letter gets the suffix that its token has in the file. Joint bytes say less than the pair in the file. But if the letters of each
    token, alone, merge into that token, its last pair is the only one with these bytes that ever meets: inside a text they merge as they do alone,
    until one of them merges with a letter outside. ``of`` tries that for all tokens.
    """

    def __init__(self, ranks: dict[bytes, int], ids: list[int]):
        import tiktoken

        self.run = tiktoken.Encoding("word-ranks", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.of_rank = np.array(ids, "<u4")

    @classmethod
    def of(cls, spec: dict) -> WordRanks | None:
        """For a file in mode ``WORDS``; None if it has other rules, or a token that its own letters do not merge into."""
        model, (split, level) = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        if (
            spec["normalizer"]["normalizers"] != _WORD_NORMALIZERS
            or (split["pattern"], split["behavior"], split["invert"]) != ({"Regex": _WORD_SPLIT}, "Removed", True)
            or level.get("add_prefix_space", True)
            or level.get("use_regex", True)
            or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges"))
        ):
            return None
        suffix, vocab, byte_of = model["end_of_word_suffix"], model["vocab"], {c: b for b, c in _ALPHABET.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        singles = [c + end for end in ("", suffix) for c in map(_ALPHABET.get, range(256))]
        order = {pair: i for i, pair in enumerate(pairs)}
        if any(c not in vocab for c in singles) or any(suffix in a or _ALPHABET[32] in a + b or not _merges_whole(a + b, suffix, order) for a, b in pairs):
            return None
        ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 32]): 256 + b for b in range(256) if b != 32}
        for i, token in enumerate(map("".join, pairs)):
            ranks[bytes(byte_of[c] for c in token.removesuffix(suffix)) + b" " * token.endswith(suffix)] = 512 + i
        return cls(ranks, [vocab[t] for t in (*singles, *map("".join, pairs))]) if len(ranks) == 511 + len(pairs) else None

    def ids(self, text: str) -> bytes:
        """Little-endian 32-bit ids; a long text is cut at white space, which no piece holds."""
        return b"".join(map(self._part, _parts(text)))

    def _part(self, text: str) -> bytes:
        ranks = self.run.encode_ordinary(" ".join(_WORD_PIECES.findall(text.lower())) + " ")
        return self.of_rank[np.frombuffer(array("I", ranks), np.uintc)].tobytes()


def _merges_whole(token: str, suffix: str, order: dict[tuple[str, str], int]) -> bool:
    """Whether the letters of a token merge into it, pair by pair as ``order`` has them; a single letter is not merged."""
    last = len(order)
    parts = [*token.removesuffix(suffix)]
    if token.endswith(suffix) and parts:
        parts[-1] += suffix
    if len(parts) < 2:
        return False
    while len(parts) > 1:
        first, at = min((order.get(pair, last), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
        if first == last:
            return False
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return True


def _parts(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PART and (space := _SPACE.search(text, at + PART)):
        yield text[at : space.start()]
        at = space.start()
    yield text[at:]


class Cache:
    """Values by chunk; when the young generation is full it becomes the old one, and the old one goes."""

    def __init__(self) -> None:
        self.young: dict = {}
        self.old: dict = {}

    def room(self) -> None:
        if len(self.young) > GENERATION:
            self.young, self.old = {}, self.young


class TextEncoder:
    """Ids of texts by a ``tokenizers`` file, without added special tokens, truncation or padding."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = [t["content"] for t in spec.get("added_tokens", []) if t.get("special")]
        self.mark = special[0] if special else None
        self.mark_id = self.library.token_to_id(self.mark) if self.mark else None
        self.mode = self._mode(spec)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.latin, self.other = Cache(), Cache()
        self.words = WordRanks.of(spec) if self.mode == WORDS else None

    def _mode(self, spec: dict) -> str:
        """How a text may be cut, read from the file; whole texts for kinds that are not known."""
        kinds = [p["type"] for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [spec.get("pre_tokenizer") or {"type": ""}])]
        steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [spec["normalizer"]] if spec.get("normalizer") else [])]
        if not self.mark or spec["model"]["type"] != "BPE":
            return WHOLE
        if kinds == ["Split", "ByteLevel"] and steps == ["NFC", "Replace", "Lowercase"] and spec["model"].get("end_of_word_suffix"):
            return WORDS
        if kinds == ["ByteLevel"] and not steps and spec["pre_tokenizer"].get("use_regex", True) and not spec["pre_tokenizer"].get("add_prefix_space"):
            return SPACED
        return WHOLE

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_new(self, chunks: list[str]) -> list[bytes]:
        """Little-endian ids of each chunk, from one call with the mark between them."""
        ids = np.array(self.library.encode_batch_fast([self.mark.join(chunks)], add_special_tokens=False)[0].ids, "<u4")
        cut = np.flatnonzero(ids == self.mark_id)
        if len(cut) != len(chunks) - 1:
            return [self.whole(c) for c in chunks]
        raw, starts, ends = ids.tobytes(), (np.append(-1, cut) + 1) * 4, np.append(cut, len(ids)) * 4
        return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]

    def _learn(self, chunks: set, cache: Cache, decode, encoded) -> None:
        """Values of ``chunks`` into the cache. A word's closing stop or comma is a token of its own."""
        cache.room()
        young, old = cache.young, cache.old
        joined, new = [], set()
        for c in chunks:
            if c in young:
                continue
            if c in old:
                young[c] = old[c]
                continue
            if c[-1:] in (b".", b",", ".", ",") and decode(c)[:-1].lstrip(" \n").lower().isalpha():
                joined.append(c)
                new.update(x for x in (c[:-1], c[-1:]) if x not in young)
            else:
                new.add(c)
        for x in [x for x in new if x in old]:
            young[x] = old[x]
            new.discard(x)
        todo = list(new)
        for i in range(0, len(todo), BATCH):
            part = todo[i : i + BATCH]
            young.update(zip(part, map(encoded, self._encode_new([decode(c) for c in part])), strict=True))
        for c in joined:
            young[c] = young[c[:-1]] + young[c[-1:]]

    def _cut(self, text: str):
        """(cache, chunks) of a text, (None, its ids), or None where only the library can tell."""
        if self.mode == WHOLE or self.special.search(text):
            return None
        if self.words and not _NOT_LATIN.search(text):
            return None, self.words.ids(text)
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            raw = None
        if self.mode == WORDS:
            return (self.other, _WORD_CHUNKS.findall(text)) if raw is None else (self.latin, raw.translate(_SMALL).split())
        if raw is None or b"\0" in raw or _ODD_BLANKS.search(raw):
            return self.other, _SPACED_CHUNKS.findall(text)
        chunks = raw.replace(b" ", b"\0 ").replace(b"\n", b"\0\n").split(b"\0")
        return self.latin, chunks if chunks[0] else chunks[1:]

    def _values(self, texts: list[str], encoded, total) -> list:
        cuts = [self._cut(t) for t in texts]
        for cache, decode in ((self.latin, lambda c: c.decode("latin-1")), (self.other, str)):
            self._learn(set().union(*(c[1] for c in cuts if c and c[0] is cache)), cache, decode, encoded)
        return [total(map(c[0].young.__getitem__, c[1])) if c and c[0] else encoded(c[1] if c else self.whole(t)) for t, c in zip(texts, cuts, strict=True)]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return self._values(texts, bytes, b"".join)

    def counts(self, texts: list[str]) -> list[int]:
        """Number of tokens of each text. An encoder serves ids or counts, not both: they share the caches."""
        return self._values(texts, lambda ids: len(ids) // 4, sum)


_ENCODERS: dict[tuple[str, str], TextEncoder] = {}


def encoder(path: str, use: str) -> TextEncoder:
    """This worker's encoder for a file and a use."""
    if (path, use) not in _ENCODERS:
        _ENCODERS[path, use] = TextEncoder(path)
    return _ENCODERS[path, use]


def slices(texts: list[str], most_chars: int = 1_000_000):
    """Runs of neighbouring texts of about ``most_chars`` characters; a longer text is a run of its own."""
    at, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t)
        if chars >= most_chars:
            yield texts[at : i + 1]
            at, chars = i + 1, 0
    if at < len(texts):
        yield texts[at:]
