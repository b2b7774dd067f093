"""The encoding of page bytes: by mark, by validity, by declaration, else by the letters they make."""

from __future__ import annotations

import codecs
import re
import sys
from collections import Counter

from pyspark import cloudpickle

# Workers get this code by value: the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Byte-order marks.
MARKS = ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16"))
# What pages mean by these names.
MEANT = {
    "iso-8859-1": "cp1252", "latin1": "cp1252", "latin-1": "cp1252", "us-ascii": "cp1252", "ascii": "cp1252",
    "gb2312": "gb18030", "gbk": "gb18030", "x-gbk": "gb18030", "shift_jis": "cp932", "x-sjis": "cp932", "shift-jis": "cp932",
    "euc-kr": "cp949", "ks_c_5601-1987": "cp949", "x-cp1251": "cp1251", "x-cp1252": "cp1252", "iso-8859-9": "cp1254",
    "tis-620": "cp874", "iso-8859-11": "cp874", "unicode": "utf-16", "iso-8859-8-i": "iso-8859-8",
}
# The letters beyond ASCII of languages, the encodings used for them, and the share that
# these letters make of what such texts hold beyond ASCII. Of alphabets of their own the ten commonest
# letters come first, of scripts with thousands of signs there are the commonest alone.
LETTERS = (
    (("cp1252",), 0.97, "äöüßÄÖÜ"),
    (("cp1252",), 0.97, "éèàçêâîôûëïùœÉÀÇÊ"),
    (("cp1252",), 0.97, "áéíóúñü¿¡ÁÉÍÓÚÑ"),
    (("cp1252",), 0.97, "ãõçáéíóúâêôàÃÕÇÁÉÍÓÚ"),
    (("cp1252",), 0.97, "åäöéÅÄÖ"),
    (("cp1252",), 0.97, "åæøéÅÆØ"),
    (("cp1252",), 0.97, "àèéìòùÀÈÉ"),
    (("cp1250", "iso8859-2"), 0.97, "ąćęłńóśźżŁŚŻ"),
    (("cp1250", "iso8859-2"), 0.97, "áčďéěíňóřšťúůýžŽŠČŘ"),
    (("cp1250", "iso8859-2"), 0.97, "áéíóöőúüűÁÉŐ"),
    (("cp1250", "iso8859-2"), 0.97, "čćđšžŠŽČ"),
    (("cp1254",), 0.97, "çğıöşüâİŞÇÖÜ"),
    (("cp1257",), 0.97, "āčēģīķļņšūžąęėįųŠŽ"),
    (("cp1251", "koi8-r", "iso8859-5", "cp866"), 0.9, "оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъёіїєґ"),
    (("cp1253",), 0.9, "αοιετνσρηκπςμλυίόάγέδωήχθφβύώξζψϊϋ"),
    (("cp1255",), 0.97, "יוהלארתשמבםנעדחקפגכטסןזצךףץ"),
    (("cp1256",), 0.97, "اليمنوترهبدعسكفةحقجشخصطثذضغزظىأإآءئؤ،"),
    (("cp874",), 0.97, "กขคงจฉชซฌญฎฏฐฑฒณดตถทธนบปผฝพฟภมยรลวศษสหฬอฮะัาำิีึืุูเแโใไ็่้๊๋์"),
    (("cp932", "euc-jp"), 0.45, "あいうえおかきくけこさしすせそたちつてとなにのはまもやよらりるれろわをんがでどだっ"),
    (("gb18030",), 0.25, "的一是不了在人有我他这个们中来上大为和国地到以说时要就出会可也你对生能而子那得于着下自之年"),
    (("big5",), 0.25, "的一是不了在人有我他這個們中來上大為和國地到以說時要就出會可也你對生能而子那得於著下自之年"),
    (("cp949",), 0.25, "이다는의에을를가은로하고지한도기사인리서어나시대자"),
)
_ALPHABETS = frozenset(("cp1251", "koi8-r", "iso8859-5", "cp866", "cp1253", "cp1255", "cp1256"))
# Signs of any text, and those that only wide scripts have.
_COMMON = frozenset("“”‘’„«»–—…·•©®™°€£§ ­")
_WIDE = frozenset("、。，！？「」（）：；　・")
_DECLARED = re.compile(rb"""charset\s*=\s*["']?\s*([\w.:-]+)""", re.IGNORECASE)
_TAGS = re.compile(rb"<[^>]*+>")
# Bytes that the letters are counted in; they need not lie at the start.
_LOOKED_AT = 1 << 16


def _known(name: str) -> str | None:
    name = MEANT.get(name.lower(), name)
    try:
        return codecs.lookup(name).name
    except LookupError:
        return None


def _mostly_utf8(content: bytes) -> bool:
    """Whether sequences of UTF-8 outnumber what is none, four to one."""
    text = content.decode("utf-8", errors="replace")
    bad = text.count("�")
    return sum(c > "\x7f" for c in text) - bad >= 4 * bad


def _wide_unmarked(content: bytes) -> str | None:
    """UTF-16 without a mark: every other byte of ASCII letters is zero."""
    if content.count(0) * 5 < len(content):
        return None
    return "utf-16-le" if content[1::2].count(0) > content[::2].count(0) else "utf-16-be"


def guess(content: bytes) -> str:
    """The encoding in which the bytes beyond ASCII make most of some language's letters.

    Decoded in a wrong one, letters become signs, capitals or letters of several languages at once,
    or cannot be decoded. Ties go to the first encoding of ``LETTERS``.
    """
    plain = _TAGS.sub(b" ", content)
    if plain.isascii():
        plain = content
    # Lines with something beyond ASCII, wherever they are.
    lines, size = [], 0
    for line in plain.split(b"\n"):
        if not line.isascii() and size < _LOOKED_AT:
            lines.append(line)
            size += len(line)
    sample = b"\n".join(lines)
    best, found = "cp1252", 0.0
    for encodings, share, letters in LETTERS:
        for encoding in encodings:
            text = sample.decode(encoding, errors="replace")
            beyond = Counter(c for c in text if c > "\x7f" and c not in _COMMON and c not in _WIDE)
            total = beyond.total()
            if not total or beyond["�"] * 50 > total:
                continue
            score = min(1.0, sum(beyond[c] for c in set(letters)) / total / share)
            if encoding in _ALPHABETS:
                # Another alphabet's letters would be as many, but not as common.
                score *= 0.5 + 0.5 * min(1.0, sum(beyond[c] for c in letters[:10]) / total / 0.55)
            if score > found + 1e-9:
                best, found = encoding, score
    return best


def encoding_of(content: bytes) -> str:
    for mark, encoding in MARKS:
        if content.startswith(mark):
            return encoding
    wide = _wide_unmarked(content)
    if wide:
        return wide
    try:
        content.decode("utf-8")
        return "utf-8"
    except UnicodeDecodeError:
        pass
    declared = _DECLARED.search(content)
    named = _known(declared[1].decode("ascii", "ignore")) if declared else None
    if named and not named.startswith("utf-16"):
        return named
    return "utf-8" if _mostly_utf8(content) else guess(content)


def decode_page(content: bytes) -> str:
    return content.decode(encoding_of(content), errors="ignore")
