"""Character facts shared by the text operators: alphabets, look-alikes, and how bytes look under another encoding."""

from __future__ import annotations

import re
from functools import lru_cache

# Letters beyond ASCII and marks that the corpus languages (fi, sv, en, de, et, ru) use.
LATIN_LETTERS = "åäöõüšžéßÅÄÖÕÜŠŽÉ"
CYRILLIC_LETTERS = "абвгдеёжзийклмнопрстуфхцчшщъыьэюяАБВГДЕЁЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ"
TYPOGRAPHY = "”“„’‘–—…§°«»"

# Cyrillic and Greek letters and the Latin letter each looks like.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ї": "ï", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ӏ": "l", "ӓ": "ä", "ӧ": "ö",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "І": "I", "Ї": "Ï", "Ј": "J", "Ѕ": "S", "Һ": "H", "Ӏ": "I", "Ӓ": "Ä", "Ӧ": "Ö",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
}

#: One-byte encodings a text may have been written in or read with: those of Latin letters, those of Cyrillic ones.
LATIN_CODECS = ["cp1252", "mac_roman", "cp850", "cp437", "cp1250", "iso8859-15", "cp1257"]
CYRILLIC_CODECS = ["cp1251", "koi8-r", "cp866", "iso8859-5"]
#: (written, read): every true encoding with every other one that a text may have been decoded with.
TRANSFORMS = [(w, r) for w in ["utf-8", *LATIN_CODECS, *CYRILLIC_CODECS] for r in LATIN_CODECS + CYRILLIC_CODECS if w != r]


@lru_cache(maxsize=None)
def _bytes_of(encoding: str) -> dict[int, str]:
    """Byte, as the character of that number, for each character above ASCII of a one-byte encoding.

    Bytes the encoding leaves open, and the C1 controls, stand for themselves, as lenient decoders have it.
    """
    table = {b: chr(b) for b in range(128, 160)}
    for b in range(128, 256):
        try:
            table[ord(bytes([b]).decode(encoding))] = chr(b)
        except UnicodeDecodeError:
            table[b] = chr(b)
    return table


_RUNS = re.compile(r"[^\x00-\x7f]+")
_UTF8 = re.compile("[Â-ß][\u0080-¿]|[à-ï][\u0080-¿]{2}|[ð-ô][\u0080-¿]{3}")


def _decoded(m: re.Match) -> str:
    try:
        return m[0].encode("latin-1").decode("utf-8")
    except UnicodeDecodeError:
        return m[0]


#: What a UTF-8 sequence may stand for: the letters of the corpus, and any character of one-byte Western text (garbled twice).
_PLAUSIBLE = {c for c in map(chr, _bytes_of("cp1252"))} | set(map(chr, range(0x80, 0x100))) | set(CYRILLIC_LETTERS + LATIN_LETTERS + TYPOGRAPHY) | set("\ufeff\u2116")


def undo(token: str, written: str, read: str) -> str | None:
    """``token`` as it was before it was decoded with ``read`` in place of ``written``; None where it wasn't.

    UTF-8 sequences are taken back wherever they stand; a one-byte encoding must explain every character.
    """
    table = _bytes_of(read)
    if written == "utf-8":
        def run(m: re.Match) -> str:
            raw = "".join(table.get(ord(c), "￿") for c in m[0])
            out, last = [], 0
            for u in _UTF8.finditer(raw):
                d = _decoded(u)
                if d in _PLAUSIBLE:
                    out += [m[0][last : u.start()], d]
                    last = u.end()
            return "".join(out) + m[0][last:]

        new = _RUNS.sub(run, token)
        return new if new != token else None
    raw = token.translate(table)
    if any(ord(c) > 255 for c in raw) or any(ord(c) > 127 and ord(c) not in table for c in token):
        return None
    try:
        new = raw.encode("latin-1").decode(written)
    except UnicodeDecodeError:
        return None
    return new if new != token else None


#: Ligatures, full-width forms, the Angstrom sign, spaces, invisible characters and separate accents: another matter than encoding.
OTHER_FORMS = "\ufb00-\ufb06\uff01-\uffee\u212b\u0132\u0133\u00a0\u00ad\u0300-\u036f\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff"


def skeleton(token: str) -> str:
    """Lower-case ASCII letters and digits of ``token``: equal for a garbled word and its clean twin."""
    return "".join(c for c in token.lower() if c.isascii() and c.isalnum())
