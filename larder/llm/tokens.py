"""Token ids of whole texts by a tokenizers file, with the ids of words kept between texts.

Most of a text is words seen before. A text is cut where the tokenizer never joins anything, each
part is encoded when it is first met, and the ids of a text are the parts' ids in a row: the same
ids as for the whole text. Special tokens' strings count as ordinary text.
"""

import codecs
import os
import re
import struct

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

KEEP = 400_000    # parts of a generation; a worker remembers two
LONG_PART = 64    # longer parts are not remembered

# a blank joins the word behind it, unless other white space stands next to it
_BLANK = re.compile(r"(?<!\s) (?!\s)")
_RARE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CONTROLS = "\x1c\x1d\x1e\x1f"  # white space for str.split, but not for the tokenizer
_UNUSUAL = "\t\x0b\x0c\r" + _CONTROLS
_MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"

# texts of Latin-1, where white space and capitals are one to one and nothing is composed
_LATIN = "".join(map(chr, range(256)))
_LOWER = "".join(" " if c in "\t\n\x0b\x0c\r\x85\xa0" else c.lower() for c in _LATIN).encode("latin-1")
_KINDS = "".join("a" if c.isalnum() else "," if c in ",." else c if c == " " else "-"
                 for c in _LOWER.decode("latin-1")).encode()


def _latin_words(text: str) -> list[str]:
    """The words of a text of Latin-1 in lower case, commas and full stops at their end apart."""
    plain = text.encode("latin-1").translate(_LOWER) + b" "
    kinds = plain.translate(_KINDS)
    # other marks before them belong to one part with them
    if b"-, " not in kinds and b",, " not in kinds:
        plain = plain.replace(b", ", b" , ").replace(b". ", b" . ")
    return plain.decode("latin-1").split(" ")


_encoders: dict[tuple[str, str], "Encoder"] = {}


def _byte_letters() -> dict[int, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


_LETTERS = "".join(chr(c) for _, c in sorted(_byte_letters().items()))


class _Parts(dict):
    """Ids of parts, made when first asked for; two generations, so that it stays bounded."""

    def __init__(self, coder: "Encoder", lead: str):
        super().__init__()
        self.coder, self.lead, self.older = coder, lead, {}
        # a word of ASCII letters stands for itself in the vocabulary
        self.shown, self.lower, self.tokenize = coder.shown(lead), coder.normalizer is not None, coder.model.tokenize

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            if key.isascii() and key.isalpha():
                value = packed([t.id for t in self.tokenize(self.shown + (key.lower() if self.lower else key))])
            else:
                value = self.coder.part(key, self)
        if len(key) <= LONG_PART:
            if len(self) >= KEEP:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


_FORMATS = [f"<{n}I" for n in range(LONG_PART + 2)]


def packed(ids: list[int]) -> bytes:
    return struct.pack(_FORMATS[len(ids)] if len(ids) < len(_FORMATS) else f"<{len(ids)}I", *ids)


class Encoder:
    """cut: 'blank' if the tokenizer joins blanks to words, 'word' if it drops white space, 'none'.

    The first two are for byte-level vocabularies that split letters, digits and other characters.
    """

    def __init__(self, path: str, cut: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.path, self.cut, self.lead = path, cut, " " if cut == "blank" else ""
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        self.parts = _Parts(self, self.lead)
        self.bare = _Parts(self, "") if self.lead else self.parts
        self.newline, self.tails = self._whole("\n"), {}

    def __reduce__(self):
        # a task gets the driver's encoders with its code; a pickled tokenizer forgets encode_special_tokens
        return Encoder, (self.path, self.cut)

    def shown(self, word: str) -> str:
        """A word as the vocabulary writes it."""
        return codecs.charmap_decode(word.encode(), "strict", _LETTERS)[0]

    def _whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        """Ids of what the tokenizer never splits before its merges."""
        return packed([t.id for t in self.model.tokenize(self.shown(word))])

    def part(self, part: str, known: _Parts) -> bytes:
        """Ids of a part: letters, perhaps with marks behind them, or anything else as a whole."""
        body, lead = part.rstrip(_MARKS), known.lead
        if not body.isalpha():
            if "\n" in part and self.cut == "blank":
                head, *lines = part.split("\n")
                if head and all(x and not (x[0].isspace() or x[-1].isspace()) for x in (head, *lines)):
                    # a newline between other characters is a token by itself
                    return self.newline.join([known[head], *map(self.bare.__getitem__, lines)])
            return self._whole(lead + part)
        tail = part[len(body):]
        if self.normalizer is not None:
            if body.isascii() or max(body) <= "\xff":
                body = body.lower()
            else:
                body = self.normalizer.normalize_str(body)
                if not body.isalpha():
                    return self._whole(lead + part)
        if not tail:
            return self._word(lead + body)
        if tail not in self.tails:
            if len(self.tails) >= KEEP:
                self.tails.clear()
            self.tails[tail] = self._word(tail)
        return known[body] + self.tails[tail]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; a null text has none."""
        out, part = [], self.parts.__getitem__
        for t in texts:
            t = t or ""
            if self.cut == "blank":
                odd = ("  " in t or " \n" in t or "\n " in t or any(c in t for c in _UNUSUAL)
                       or not t.isascii() and _RARE.search(t))
                head, *rest = _BLANK.split(t) if odd else t.split(" ")
                out.append((self.bare[head] if head else b"") + b"".join(map(part, rest)))
            elif self.cut == "word":
                try:
                    words = _latin_words(t)
                except UnicodeEncodeError:
                    words = None if any(c in t for c in _CONTROLS) else t.split()
                out.append(self._whole(t) if words is None else b"".join(map(part, words)))
            else:
                out.append(self._whole(t))
        return out


def encoder(path: str, cut: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if (path, cut) not in _encoders:
        _encoders[path, cut] = Encoder(path, cut)
    return _encoders[path, cut]
