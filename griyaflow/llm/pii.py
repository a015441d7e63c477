"""Personal information in free text: weak labelers, expectation-maximisation, a trained span classifier.

Candidates of five types are cut out of the whole text, once, by broad patterns that also take what only
looks like a mention (handles, codes, amounts, capitalised words of any kind); names go word by word. Per
type, labelers look at each: a pattern labeler (its form), a gazetteer labeler (street, area, domain, office
and common given names), a context labeler (the words around) and, for names, a corpus labeler: how the
word is written and what it follows over all documents, for the words that make up one in ``LEXICON``
of all words, so at most so many. Each votes yes, no or nothing. Votes are counted by pattern over all
documents; expectation-maximisation on these counts, at most 81 per type, estimates each labeler's
reliability without any true label and gives each vote pattern a probability. With these as soft labels
a logistic classifier over votes, neighbouring words, letters and shapes is fitted on a bounded sample of
candidates, of the least hashes of document and place, and decides on every candidate of every text. A
name's letters are first read by a classifier of their own (affixes), whose score is one feature; the sample
is seen whole, without letters and without votes, so that context carries a name never seen before and
letters one without any context. Words that are names are joined to spans with initials and ``binti``; overlapping spans keep the
earlier type of TYPES.

Defined results: a null or empty text has no mention; positions count code points; texts of any length
are read whole; repeated documents give their mentions again; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type

from griyaflow.runtime import stored

TYPES = ("email", "id_number", "phone", "address", "name")
#: Bound of the labelled sample that the classifier is fitted on; everything else covers all documents.
SAMPLE = 30_000
WEIGHTS = 1 << 18
#: Words that make up one in so many of all words are in the lexicon: at most so many, whatever the corpus.
LEXICON = 200_000
#: Score of a name's letters: no less than minus this where form and context both say yes, no more than this where context says no.
DOUBT = 1.0
#: What letters have to say, in log-odds, where all labelers abstain.
SILENT = 0.5
#: Words, and part scores, that a task remembers at a time.
REMEMBERED = 200_000

# What the gazetteer labelers know.
STREET_WORDS = ("jl", "jln", "jalan", "gg", "gang", "lorong", "perum", "perumahan", "komplek", "kompleks", "dusun", "dsn", "dukuh", "kampung", "kp")
STREET_SHORT = ("jl", "jln", "gg", "dsn", "kp", "perum")
# Words that follow a street word where it is no address.
NO_STREET = {"setapak", "selebar", "sempit", "menuju", "pinggir", "dan", "yang", "di"}
MAIL_ENDS = ("example", "test", "com", "net", "org", "id", "edu", "info", "invalid", "local")
# Common given and family names of Indonesia and of English-speaking countries.
GIVEN_NAMES = {
    "abdul", "adi", "agung", "agus", "ahmad", "ali", "aminah", "andi", "anita", "ani", "arif", "asep", "ayu", "bambang", "bayu", "budi", "citra", "dedi", "dewi", "dian",
    "dwi", "edi", "eka", "eko", "endang", "eni", "fajar", "fitri", "hadi", "handayani", "hartono", "hasan", "hendra", "heri", "hidayat", "indah", "indra", "irfan", "iwan", "joko",
    "kartini", "kurniawan", "lestari", "lina", "maria", "mega", "muhammad", "mulyadi", "nina", "nugroho", "nur", "nurhayati", "permata", "prasetyo", "pratama", "purnomo", "putra", "putri", "rahayu", "rahmat",
    "ratna", "rina", "rini", "rizki", "rudi", "santoso", "sari", "setiawan", "siti", "slamet", "sri", "sugeng", "suharto", "sukarno", "sulastri", "sumarni", "sunarto", "supriyadi", "suryani", "susanti",
    "susilo", "sutrisno", "taufik", "teguh", "titik", "tono", "tri", "utami", "wahyu", "wati", "wawan", "wibowo", "widodo", "wijaya", "wulandari", "yanti", "yuli", "yusuf", "zainal", "alice",
    "andrew", "anna", "anthony", "barbara", "brown", "charles", "daniel", "david", "elizabeth", "emily", "emma", "george", "jack", "james", "jennifer", "john", "johnson", "jones", "joseph", "karen",
    "laura", "linda", "lisa", "margaret", "mark", "mary", "michael", "miller", "nancy", "patricia", "paul", "peter", "richard", "robert", "sarah", "smith", "susan", "taylor", "thomas", "william",
}
# Titles and kinship words, directly before a name.
TITLES = {
    "pak", "bu", "bapak", "ibu", "mbah", "lik", "sdr", "sdri", "saudara", "saudari", "mas", "mbak", "kang", "om", "tante", "paman", "bibi", "kakek", "nenek", "haji", "hajah", "hj", "ustaz", "tuan", "nyonya", "ny", "nona",
    "mr", "mrs", "ms", "miss", "dr", "prof", "drs", "ir", "almarhum", "almarhumah", "alm",
}
# Roles and relations that a name follows, and that are none themselves.
ROLES = {
    "surveyor", "petugas", "operator", "pelapor", "pemohon", "saksi", "pengirim", "penerima", "menantu", "tetangga", "ketua", "kepala", "keluarga", "pemilik", "penghuni", "istri", "suami", "anak", "warga", "lurah", "camat", "kades", "sekretaris", "bendahara",
    "neighbour", "neighbor", "owner", "resident", "witness", "applicant", "tenant", "officer", "rt", "rw",
}
# Field words, units, months and days; none is a name.
NO_NAMES = {
    "no", "nomor", "rp", "kk", "nik", "ktp", "hp", "wa", "telp", "tel", "fax", "email", "surel", "alamat", "blok", "kav", "jalan", "gang", "dusun", "desa", "kota", "kecamatan",
    "januari", "februari", "maret", "april", "mei", "juni", "juli", "agustus", "september", "oktober", "november", "desember", "january", "february", "march", "may", "june", "july", "august", "october", "december",
    "senin", "selasa", "rabu", "kamis", "jumat", "sabtu", "minggu", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
}
# Words before a name, and words directly after one.
NAME_BEFORE = TITLES | ROLES | {"milik", "bernama", "nama", "namanya", "jenenge", "daleme", "menurut", "menemui", "bertemu", "oleh", "ttd", "from", "met", "interviewed", "contact", "by", "said", "told", "called", "binti", "bin", "an", "dear", "yth"}
NAME_AFTER = {
    "binti", "bin", "menambahkan", "menandatangani", "mengaku", "menunjukkan", "memberi", "meminta", "mencatat", "mengatakan", "menjelaskan", "menyatakan", "melaporkan", "menempati", "menolak", "berkata", "lahir", "tinggal", "matur", "maringi",
    "said", "says", "lives", "lived", "has", "who", "told", "asked", "reported", "added", "signed",
}
PLACE_BEFORE = {"di", "ke", "dari", "ing", "in", "at", "near", "desa", "kelurahan", "kecamatan", "kabupaten", "kota", "provinsi", "village", *STREET_WORDS}
PHONE_NEAR = {"hp", "wa", "telp", "telepon", "telpon", "tel", "phone", "call", "kontak", "hubungi", "dihubungi", "nomere", "nomor", "contact", "reached", "key", "sdr", "sdri"}
ID_NEAR = {"nik", "kk", "ktp", "induk", "kartu", "card", "id", "bernomor", "nomer", "number", "ne", "e"}
NO_NUMBER = {"bayar", "tiket", "ticket", "rp", "tkt", "img", "koordinat", "coordinates", "sidik", "digest", "darurat", "berkas", "layanan"}
MAIL_NEAR = {"surel", "email", "mail", "surele", "ke", "tembusan", "dari", "pengirim", "from", "write", "to", "menyang", "kirim", "by"}
ADDRESS_NEAR = {"alamat", "lokasi", "beralamat", "terletak", "di", "warga", "at", "lengkap", "rumahnya", "ing", "to", "stands"}

_AT = r"(?:@|\[ ?at ?\]|\( ?at ?\)|\{ ?at ?\})"
_DOT = r"(?:\.|\[ ?dot ?\]|\( ?dot ?\)|\{ ?dot ?\})"
EMAIL = re.compile(rf"(?<![\w.%+-])[A-Za-z0-9](?:[A-Za-z0-9_%+-]|{_DOT}(?=[A-Za-z0-9]))*[ ]?{_AT}[ ]?[A-Za-z0-9][A-Za-z0-9-]*(?:[ ]?{_DOT}[ ]?(?<!\. )(?<! \.)[A-Za-z0-9][A-Za-z0-9-]*)+", re.I)
ID_NUMBER = re.compile(r"(?<![\w.-])(?:\d{16}|\d{4}([ .-])\d{4}\1\d{4}\1\d{4}|\d{2}\.\d{2}\.\d{2}\.\d{6}\.\d{4}|\d{6}([ .-])\d{6}\2\d{4})(?![\w]|[.-]\d)")
PHONE = re.compile(r"(?<![\w.-])(?:(?:\(\+?62\)|\+?62)[ .-]?\d{2,4}(?:[ .-]?\d{3,4}){1,3}|\(0\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{2,4}|0\d{2,3}[ .-]\d{3,4}[ .-]\d{3,4}|0\d{8,12})(?![\w]|[.-]\d)")
_RT = r"RT[ .]{0,2}\d{1,3}(?:[ ,]*/?[ ]*RW[ .]{0,2}\d{1,3}|[ ]*/[ ]*\d{1,3})?"
_HOUSE = rf"(?:(?:no|nomor|kav)[ .]{{0,2}}\d{{1,4}}[a-z]?|blok[ ]+[a-z]{{1,2}}(?:[ /.-]{{0,2}}(?:no[ .]{{0,2}})?\d{{1,4}}[a-z]?)?|[ivxlc]+[ ]?/[ ]?\d{{1,4}}[a-z]?|{_RT}|\d{{1,4}}[a-z]?)(?![\w])"
ADDRESS = re.compile(rf"(?<![\w@])(?:(?:{'|'.join(STREET_SHORT)})\b[ ]?\.?[ ]*|(?:{'|'.join(STREET_WORDS)})\b[ ]+)(?:[^\W\d_]+[ ]+){{1,4}}?{_HOUSE}(?:[ ]*,?[ ]*{_HOUSE})*", re.I)
#: What looks like a number or a mail address at first sight; where no stricter pattern holds, it is a candidate that the labelers have to turn down.
LIKE = {"email": re.compile(r"@\w+"), "phone": re.compile(r"(?<![\w])[+(]?\d(?:[ .)/-]{0,2}\d){6,18}(?!\w)")}
WORD = re.compile(r"[^\W\d_]+")
CAPITAL = re.compile(r"(?<![^\W_])[^\W\d_a-z][^\W\d_]+(?![\w@])")
SMALL = re.compile(r"(?<![\w@])[a-z]{2,}(?![\w@])")
ANY_WORD = re.compile(r"(?<![^\W_])[^\W\d_]{2,}(?![\w@])")
BIG, LITTLE = re.compile(r"[A-Z]"), re.compile(r"[a-z]")
FIRST = re.compile(r"(?:\W*\d\d:\d\d\W+)?(?:\W*[^\W\d_]+ ?[:>] ?)?[^\w@]*([^\W\d_])")
BEFORE = re.compile(r"([^\W\d_]+)([^\w@]*)$")
AFTER = re.compile(r"([^\w@]*)([^\W\d_]+)")
LINK = re.compile(r"[ \u00a0]{1,2}(?:(?:binti|bin)[ \u00a0]{1,2})?(?:[A-Za-z]\.[ \u00a0]{1,2})*", re.I)
NUMBER = re.compile(r"[ .\u00a0]{0,2}\d")
TAIL = re.compile(r"(?:[ \u00a0]{1,2}[A-Za-z]\.)+(?![\w.]*@)")
#: A word before or after a candidate is looked for within so many characters; longer gaps are none.
NEAR = 40
PATTERNS = {"email": EMAIL, "id_number": ID_NUMBER, "phone": PHONE, "address": ADDRESS}
_STRICT = {
    "email": re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+$"),
    "phone": re.compile(r"(?:\+?62|\(\+62\) |0)[ -]?8\d\d[ .-]?\d{3,4}[ .-]?\d{2,4}$|\(0\d{3}\) \d{6}$"),
    "address": re.compile(r"\S+ \S+ (?:\S+ )?(?:no|kav|blok|rt|[ivx]+/|\d)", re.I),
}


class _Words:
    """Words of a text near a place, looked up where they are asked for."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, None, None

    def before(self, at: int, n: int) -> list[str]:
        if self.starts is None:
            spans = [m.span() for m in WORD.finditer(self.text)]
            self.starts, self.ends = [s for s, _ in spans], [e for _, e in spans]
        i = bisect_left(self.starts, at)
        return [self.text[s:e].lower() for s, e in zip(self.starts[max(0, i - n) : i], self.ends[max(0, i - n) : i], strict=True) if e <= at]


def _vote(yes: bool, no: bool) -> str:
    return "y" if yes and not no else "n" if no and not yes else "-"


def _number_votes(kind: str, surface: str, words: _Words, start: int) -> str:
    digits = re.sub(r"\D", "", surface)
    near = words.before(start, 4)
    bad = any(w in NO_NUMBER for w in near[-2:])
    good = any(w in (PHONE_NEAR if kind == "phone" else ID_NEAR) for w in near)
    if kind == "phone":
        whole = PHONE.fullmatch(surface)
        return _vote(bool(_STRICT["phone"].match(surface)), not whole or len(digits) < 9 or len(digits) > 14) + _vote(digits.startswith(("08", "628", "02")), not digits.startswith(("0", "62"))) + _vote(good, bad)
    day, month = int(digits[6:8]), int(digits[8:10])
    dated = (1 <= day <= 31 or 41 <= day <= 71) and 1 <= month <= 12
    return _vote(dated, not dated) + _vote(len(digits) < len(surface) or digits[0] == "4", digits.startswith("88")) + _vote(good, bad)


def _other_votes(kind: str, text: str, s: int, e: int, words: _Words) -> str:
    surface, near = text[s:e], words.before(s, 2)
    if kind == "email":
        ends = surface.lower().rstrip(" )]}").endswith(MAIL_ENDS)
        bare = s > 0 and text[s - 1] == "/" or surface[0] == "@"
        return _vote(bool(_STRICT["email"].match(surface)), surface[0] == "@") + _vote(ends, not ends) + _vote(any(w in MAIL_NEAR for w in near) or text[max(0, s - 1) : s] == "<", bare)
    first = re.match(r"\W*(\w+)", surface).group(1).lower()
    second = surface.split()[1:2]
    lower = bool(second) and second[0].islower() and surface[0].isupper()
    other = bool(NO_STREET & set(re.findall(r"\w+", surface.lower())))
    figures = re.search(r"\d", surface)
    return _vote(bool(_STRICT["address"].match(surface)) and not lower, figures is None or other) + _vote(first in STREET_WORDS and not other, other) + _vote(any(w in ADDRESS_NEAR for w in near) or bool(re.search(r"[|;:=,-]\s*$", text[max(0, s - 3) : s])), False)


def _gap(text: str) -> str:
    """What stands between two words: s a space, p an end of a sentence, c a field's sign, k a comma, n a line's end, o the rest."""
    if text in (" ", "  ", "\u00a0"):
        return "s"
    if "\n" in text:
        return "k" if text.startswith(",") else "n"
    bare = text.strip(" \t\u00a0")
    if not bare:
        return "s"
    return "c" if bare in (":", "=", "-", "|") else "k" if bare == "," else "p" if bare[0] in ".!?" else "o"


#: A candidate: type, span, word in lower case or surface, votes (for names without the corpus labeler's), and of names: previous word with
#: its gap, next word with its gap, shape, whether it is linked to the candidate before it, and the span with its initials.
Candidate = tuple[int, int, int, str, str, str, str, str, bool, int, int]
NAME = TYPES.index("name")


def _case(line: str) -> str:
    """l: a line that begins in lower case, after a time or who speaks; u: in upper case, mostly; m: as usual."""
    first = FIRST.match(line)
    if first and first.group(1).islower():
        return "l"
    return "u" if len(BIG.findall(line)) > len(LITTLE.findall(line)) else "m"


def _shape(word: str, case: str, gap: str, follows: bool) -> str:
    """m capitalised within a sentence, o at its beginning, b there before another capital, t with small letters in a line of capitals,
    u in capitals there, a in capitals elsewhere, l in small letters."""
    if word.islower():
        return "l"
    if word.isupper():
        return "u" if case == "u" else "a"
    if case == "u":
        return "t"
    return "m" if gap in "sk" else "b" if follows else "o"


def name_words(text: str, taken: bytearray, ordinary: frozenset[str]) -> list[Candidate]:
    """Candidates for words of names, in order, with initials and what is around them. An ordinary word is one only where it is
    capitalised within a sentence."""
    spans: list[tuple[int, int, str]] = []
    at = 0
    for line in text.split("\n"):
        case = _case(line)
        end = at + len(line)
        for m in (CAPITAL if case == "m" else ANY_WORD).finditer(text, at, end):
            s, e = m.span()
            if taken[s] or taken[e - 1] or (s and text[s - 1] in "@_&/#"):
                continue
            low = m.group().lower()
            if low in ("binti", "bin") or low in ordinary and (text[s].islower() or s < 2 or text[s - 1] not in " \u00a0" or text[s - 2] in ".!?:>|"):
                continue
            spans.append((s, e, case))
        at = end + 1
    out: list[Candidate] = []
    last_end, chain = -1, "-"
    for s, e, case in spans:
        low = text[s:e].lower()
        link = LINK.fullmatch(text, last_end, s) is not None if 0 <= last_end < s <= last_end + NEAR else False
        first = s
        while first >= 3 and text[first - 1] in " \u00a0":  # initials with their dots before it
            k = first - 1
            while k > 0 and text[k - 1] in " \u00a0":
                k -= 1
            if k < 2 or text[k - 1] != "." or not text[k - 2].isalpha() or (k > 2 and (text[k - 3].isalnum() or text[k - 3] in ".'-_")) or first - k > 2:
                break
            first = k - 2
        m = BEFORE.search(text, max(0, first - NEAR), first)
        before, gap = (m.group(1).lower(), _gap(m.group(2))) if m else ("", _gap(text[max(0, first - NEAR) : first]) if first else "n")
        m = AFTER.match(text, e, e + NEAR)
        after, agap = (m.group(2).lower(), _gap(m.group(1))) if m else ("", "o")
        shape = _shape(text[s:e], case, gap, bool(m) and agap == "s" and text[m.start(2)].isupper())
        own = low in NAME_BEFORE or low in NO_NAMES
        cue = before in NAME_BEFORE and (gap in "sckp" if before in TITLES else gap in "sck") or after in NAME_AFTER and agap in "sk" or before in ("n", "a") and gap == "p" and text[max(0, first - 6) : first].lower().endswith("a.n. ")
        place = before in PLACE_BEFORE and gap in "sp" and not (before == "dari" and cue)
        direct = "n" if own or place else "y" if cue else "-"
        if direct == "-" and NUMBER.match(text, e):
            direct = "n"
        if direct == "-" and link and shape in "mat" and chain != "-" and gap == "s":
            direct = chain
        chain = "-" if own else direct
        m = TAIL.match(text, e)
        field = cue and gap == "c" and shape in "ob"
        votes = _vote((shape in "mt" or field) and direct != "n", False) + _vote(low in GIVEN_NAMES, own) + direct
        out.append((NAME, s, e, low, votes, before + gap, after + agap, shape, link, first, m.end() if m else e))
        last_end = e
    return out


def candidates(text: str, ordinary: frozenset[str] = frozenset()) -> list[Candidate]:
    """All candidates of the whole text, those of names last and in order."""
    out: list[Candidate] = []
    words = _Words(text)
    taken = bytearray(len(text))  # places that an earlier type holds
    digits = any(map(str.isdigit, text))
    for k, kind in enumerate(TYPES[:NAME]):
        if kind == "email" and "@" not in text and "at" not in text and "AT" not in text or kind != "email" and not digits:
            continue
        for pattern in (PATTERNS[kind], LIKE.get(kind)):
            for m in pattern.finditer(text) if pattern else ():
                s, e = m.span()
                if any(taken[s:e]):
                    continue
                surface = text[s:e]
                votes = _number_votes(kind, surface, words, s) if kind in ("phone", "id_number") else _other_votes(kind, text, s, e, words)
                out.append((k, s, e, surface, votes, "", "", "", False, s, e))
                if pattern is PATTERNS[kind]:
                    taken[s:e] = b"\x01" * (e - s)
    return out + name_words(text, taken, ordinary)


def corpus_vote(seen: tuple[int, int, int, int, int] | None) -> str:
    """Vote of the corpus labeler from a word's counts: in small letters among mixed ones, as a candidate, of these
    capitalised within a sentence, after a cue, after a place word."""
    if seen is None or seen[0] + seen[1] < 5:
        return "-"
    low, n, mid, yes, no = seen
    if low > 0.4 * (low + n):
        return "n"
    if yes >= 0.25 * n and yes > 2 * no:
        return "y"
    return "n" if no >= 0.5 * n or (n >= 20 and mid < 0.1 * n) else "-"


def name_votes(c: Candidate, lexicon: dict[str, tuple], follows: bool = False) -> str:
    """All votes for a word; ``follows``: linked to a word that is a name."""
    votes = c[4]
    if follows and votes[2] == "-":
        votes = votes[:2] + "y"
    return votes + corpus_vote(lexicon.get(c[3]))


def _hashed(*names: str) -> list[int]:
    return [zlib.crc32(n.encode()) % WEIGHTS for n in names]


def vote_features(kind: int, votes: str, shape: str) -> list[int]:
    return _hashed(*[f"{kind}:{i}{v}" for i, v in enumerate(votes)], f"{kind}:v{votes}", f"{kind}:h{shape}", f"{kind}:b")


def own_features(kind: int, surface: str) -> list[int]:
    """Features of a candidate's own letters or digits."""
    low = surface.lower()
    if kind == NAME:
        named = [f"p{low[:k]}" for k in (2, 3, 4, 5)] + [f"s{low[-k:]}" for k in (2, 3, 4, 5, 6)] + [f"l{min(len(low), 14)}", "own"]
    elif kind in (TYPES.index("phone"), TYPES.index("id_number")):
        digits = re.sub(r"\D", "", surface)
        named = [f"d{digits[:2]}", f"l{len(digits)}", "x" + re.sub(r"\d+", "9", surface)]
    elif kind == TYPES.index("email"):
        named = [f"s{low[-4:]}", f"@{low[0] == '@'}"]
    else:
        named = [f"w{w}" for w in re.findall(r"[^\W\d_]+", low)[:2]] + ["x" + re.sub(r"[^\W\d_]+", "a", re.sub(r"\d+", "9", low))]
    return _hashed(*[f"{kind}:{n}" for n in named])


def letter_features(score: float, shape: str) -> list[int]:
    """Of a name's word: what its letters alone say, in steps that it reaches, and that together with its shape."""
    coarse = int(score > -1) + int(score > 0.5)
    return _hashed(*[f"letters{t / 2}" for t in range(-10, 9) if 2 * score >= t], f"letters{coarse}{shape}", f"shape{shape}", "letters")


def around_features(before: str, after: str) -> list[int]:
    return _hashed(f"<{before}", f">{after}", f"g{before[-1:]}", f"a{after[-1:]}")


# What is believed of a labeler before any data: (yes, no) on mentions, (yes, no) on others; a twentieth as strong as the data.
BELIEF = {"pattern": ((0.7, 0.1), (0.2, 0.5)), "gazetteer": ((0.5, 0.02), (0.05, 0.5)), "context": ((0.6, 0.05), (0.1, 0.3)), "corpus": ((0.6, 0.05), (0.05, 0.6))}
STRENGTH = 0.05
LABELERS = tuple(BELIEF)


def expectation_maximisation(counts: dict[str, float], rounds: int = 100) -> tuple[dict[str, float], np.ndarray, float]:
    """Posterior of each vote pattern, P(vote | class) as [labeler, class, y/n/-], and the share of mentions."""
    patterns = sorted(counts)
    if not patterns:
        return {}, np.zeros((0, 2, 3)), 0.0
    n = np.array([counts[p] for p in patterns], float)
    votes = np.array([["yn-".index(v) for v in p] for p in patterns])
    belief = np.array([[[y, no, 1 - y - no] for y, no in (BELIEF[k][1], BELIEF[k][0])] for k in LABELERS[: votes.shape[1]]])
    rely, prior = belief.copy(), 0.5
    post = np.zeros(len(patterns))
    for _ in range(rounds):
        logit = np.log(prior / (1 - prior)) + sum(np.log(rely[j, 1, votes[:, j]] / rely[j, 0, votes[:, j]]) for j in range(votes.shape[1]))
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        prior = float(np.clip((n * post).sum() / n.sum(), 1e-4, 1 - 1e-4))
        for j in range(votes.shape[1]):
            for c, w in ((0, n * (1 - post)), (1, n * post)):
                seen = np.array([w[votes[:, j] == v].sum() for v in range(3)])
                seen = seen + (STRENGTH * w.sum() + 1) * belief[j, c]
                rely[j, c] = seen / seen.sum()
    return dict(zip(patterns, post.tolist(), strict=True)), rely, prior


def fit(rows: list[list[int]], label: np.ndarray, weight: np.ndarray | None = None, start: np.ndarray | None = None, rounds: int = 120, rate: float = 0.3, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression on hashed features with soft labels (Adagrad, whole sample per round)."""
    w = np.zeros(WEIGHTS) if start is None else start.copy()
    if not rows:
        return w
    weight = np.ones(len(rows)) if weight is None else weight
    flat = np.concatenate([np.asarray(r, np.int64) for r in rows])
    used, flat = np.unique(flat, return_inverse=True)
    v, g2 = np.zeros(len(used)) if start is None else start[used], np.full(len(used), 1e-8)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(of, v[flat], len(rows)), -30, 30)))
        g = np.bincount(flat, (weight * (p - label))[of], len(used)) / len(rows) + decay * v
        g2 += g * g
        v -= rate * g / np.sqrt(g2)
    w[used] = v
    return w




_FIELDS = pa.struct([("kind", pa.int8()), ("s", pa.int32()), ("e", pa.int32()), *[(c, pa.string()) for c in ("w", "votes", "before", "after", "shape")], ("link", pa.bool_()), ("s2", pa.int32()), ("e2", pa.int32())])


def _small_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) how often words stand in small letters among others, in parts."""
    small: Counter = Counter()

    def part() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(small), pa.string()), pa.array(list(small.values()), pa.int64())], names=["word", "n"])
        small.clear()
        return out

    for b in batches:
        for text in b.column(0).to_pylist():
            for line in (text or "").split("\n"):
                if _case(line) != "l":
                    small.update(SMALL.findall(line))
        if len(small) > REMEMBERED:
            yield part()
    yield part()


def _cut(ordinary: frozenset[str], id_type: pa.DataType):
    """One row per document with its candidates, made column by column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                docs, texts = b.column(0).slice(at, 1000), b.column(1).slice(at, 1000).to_pylist()
                found = [candidates(t, ordinary) if t else [] for t in texts]
                columns = list(zip(*[c for f in found for c in f], strict=True)) or [()] * len(_FIELDS)
                flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FIELDS, strict=True)], fields=list(_FIELDS))
                ends = np.r_[0, np.cumsum([len(f) for f in found])].astype(np.int32)
                yield pa.RecordBatch.from_arrays([docs.cast(id_type), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["doc_id", "found"])

    return run


def found_in(column: pa.ListArray) -> Iterator[list[Candidate]]:
    """The candidates of every document of a batch that :func:`_cut` made."""
    flat = column.flatten()
    rows = list(zip(*[f.to_pylist() for f in flat.flatten()], strict=True))
    at = 0
    for n in column.value_lengths().to_pylist():
        yield rows[at : at + (n or 0)]
        at += n or 0


def train(examples: list[tuple], posterior: dict[tuple[int, str], float], n_of: dict, share: dict) -> np.ndarray:
    """Weights of the classifier from (type, surface, votes, before, after, shape), of strata (type, held for a mention) with n_of
    candidates of which the first ``share`` count."""
    taken: Counter = Counter()
    rows, label = [], []
    for r in examples:
        stratum = (r[0], posterior[r[0], r[2]] > 0.5)
        taken[stratum] += 1
        if taken[stratum] <= share[stratum]:
            rows.append((r, stratum))
            label.append(posterior[r[0], r[2]])
    label, is_name = np.array(label), np.array([r[0] == NAME for r, _ in rows], bool)
    weight = np.array([n_of[x] / min(taken[x], share[x]) for _, x in rows])
    weight = weight / weight.mean() if len(weight) else weight
    # how far a label can be relied on; nothing where all labelers abstain
    sure = np.array([abs(2 * y - 1) if r[2].strip("-") else 0.0 for (r, _), y in zip(rows, label, strict=True)])
    # the letters of names, each half of the sample scored by the other
    letters = [own_features(NAME, r[1]) if name else [] for (r, _), name in zip(rows, is_name, strict=True)]
    half = np.arange(len(rows)) % 2
    by_letters = np.zeros(len(rows))
    for h in (0, 1):
        w = fit(letters, label, weight * sure * is_name * (half != h), rounds=300)
        by_letters[half == h] = [w[x].sum() for x, o in zip(letters, half, strict=True) if o == h]
    w = fit(letters, label, weight * sure * is_name, rounds=300)
    votes = [vote_features(r[0], r[2], r[5]) for r, _ in rows]
    around = [around_features(r[3], r[4]) if name else [] for (r, _), name in zip(rows, is_name, strict=True)]
    own = [letter_features(x, r[5]) if name else own_features(r[0], r[1]) for (r, _), x, name in zip(rows, by_letters, is_name, strict=True)]
    full = [v + a + o for v, a, o in zip(votes, around, own, strict=True)]
    # each seen whole, without its own letters, and, of names, without its votes: each must do without the others
    both = full + [v + a for v, a in zip(votes, around, strict=True)] + [a + o for a, o in zip(around, own, strict=True)]
    # what votes leave open has the label that its letters give it
    p = 1 / (1 + np.exp(-np.clip(by_letters, -30, 30)))
    now = np.where(is_name, sure * label + (1 - sure) * p**2 / (p**2 + (1 - p) ** 2), label)
    w = fit(both, np.tile(now, 3), np.r_[weight, weight * np.where(is_name, sure, 1), weight * is_name], start=w)
    return w


class Model:
    """Lexicon, reliabilities of the labelers and weights of the span classifier, from all documents (doc_id, text)."""

    def __init__(self, docs: DataFrame):
        spark, id_type = docs.sparkSession, docs.schema["doc_id"].dataType
        small = stored(docs.select("text").mapInArrow(_small_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("low")), "small")
        # words of at least one in LEXICON of all: no more than LEXICON of them
        n_small = small.agg(F.sum("low")).first()[0] or 0
        self.ordinary = frozenset(r["word"] for r in small.filter(F.col("low") >= max(5, -(-n_small // LEXICON))).select("word").collect())
        out = T.StructType([T.StructField("doc_id", id_type), T.StructField("found", from_arrow_type(pa.list_(_FIELDS)))])
        self.cut = stored(docs.select("doc_id", "text").mapInArrow(_cut(self.ordinary, to_arrow_type(id_type)), out), "candidates")
        each = self.cut.select("doc_id", F.explode("found").alias("c"))
        words = each.filter(F.col("c.kind") == NAME).groupBy(F.col("c.w").alias("word")).agg(
            F.lit(0).cast("long").alias("low"), F.count("*").alias("n"), F.count_if(F.col("c.shape").isin("m", "t")).alias("mid"),
            F.count_if(F.substring("c.votes", 3, 1) == "y").alias("yes"), F.count_if(F.substring("c.votes", 3, 1) == "n").alias("no"),
        )
        zero = F.lit(0).cast("long")
        both = words.unionByName(small.select("word", "low", *[zero.alias(c) for c in ("n", "mid", "yes", "no")]))
        counted = stored(both.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("low", "n", "mid", "yes", "no")]), "words")
        total = counted.agg(F.sum(F.col("low") + F.col("n"))).first()[0] or 0
        often = counted.filter((F.col("low") + F.col("n") >= max(5, -(-total // LEXICON))) & (F.col("n") > 0))
        self.lexicon = {r["word"]: (r["low"], r["n"], r["mid"], r["yes"], r["no"]) for r in often.collect()}
        corpus = F.broadcast(spark.createDataFrame([(w, corpus_vote(x)) for w, x in self.lexicon.items()], "w string, corpus string"))
        seen = each.select("doc_id", "c.*").join(corpus, "w", "left").withColumn("votes", F.when(F.col("kind") == NAME, F.concat("votes", F.coalesce("corpus", F.lit("-")))).otherwise(F.col("votes")))
        counts = seen.groupBy("kind", "votes").count().collect()
        self.posterior: dict[tuple[int, str], float] = {}
        self.labelers: list[tuple[str, str, float, float, float, int]] = []
        for k, kind in enumerate(TYPES):
            own = {r["votes"]: float(r["count"]) for r in counts if r["kind"] == k}
            post, rely, prior = expectation_maximisation(own)
            self.posterior |= {(k, v): p for v, p in post.items()}
            for j, name in enumerate(LABELERS[: len(rely)]):
                self.labelers.append((kind, name, float(rely[j, 1, 0]), float(rely[j, 0, 1]), prior, int(sum(own.values()))))
        self.weights = self._fitted(seen, counts)

    def _fitted(self, seen: DataFrame, counts: list) -> np.ndarray:
        """Weights from the candidates of the least hashes, the same whatever the partitions: of each type, as many that are held
        for mentions as for others, weighted back to their numbers. Labels count as far as they are sure; for the rest, such as candidates of
        which all labelers abstain, what their letters say counts."""
        held = {kv: p > 0.5 for kv, p in self.posterior.items()}
        n_of: Counter = Counter()
        for r in counts:
            n_of[r["kind"], held[r["kind"], r["votes"]]] += r["count"]
        yes = F.concat("kind", F.lit(":"), "votes").isin(*[f"{k}:{v}" for (k, v), x in held.items() if x])
        share = {(k, x): SAMPLE // 3 if k == NAME else SAMPLE // 24 for k, x in n_of}
        near = F.lit(False)
        for (k, x), m in share.items():
            near = near | ((F.col("kind") == k) & (yes if x else ~yes) & (F.col("h") <= _quantile(1.5 * m / n_of[k, x])))
        h = F.xxhash64("doc_id", "s", "kind", "w")
        examples = seen.withColumn("h", h).filter(near).orderBy("h", "kind", "w", "before", "after").select("kind", "w", "votes", "before", "after", "shape").limit(2 * SAMPLE).collect()
        return train([tuple(r) for r in examples], self.posterior, n_of, share)

    def decider(self) -> Decider:
        return Decider(self.weights, self.lexicon, self.ordinary)


def _quantile(share: float) -> int:
    """A hash of 64 bits is below this with the given chance."""
    return min((1 << 63) - 1, int(-(1 << 63) + min(1.0, share) * (1 << 64)))


class Decider:
    """The classifier's decisions; scores of words and votes are remembered, REMEMBERED of each kind at a time."""

    def __init__(self, weights: np.ndarray, lexicon: dict[str, tuple], ordinary: frozenset[str] = frozenset()):
        self.weights, self.lexicon, self.ordinary = weights, lexicon, ordinary
        self.known: list[dict] = [{}, {}, {}, {}]

    def _score(self, part: int, key: tuple, make) -> float:
        known = self.known[part]
        score = known.get(key)
        if score is None:
            if len(known) > REMEMBERED:
                known.clear()
            score = known[key] = float(self.weights[make(*key)].sum())
        return score

    def accepts(self, c: Candidate, votes: str) -> bool:
        score = self._score(0, (c[0], votes, c[7]), vote_features)
        own = self._score(1, (c[0], c[3]), own_features)
        if c[0] == NAME:
            if own < SILENT and not votes.strip("-"):
                return False
            own = self._score(3, (min(4.0, max(-5.5, (2 * own) // 1 / 2)), c[7]), letter_features)
            if votes[0] == "y" and votes[2] == "y" and votes[3] != "n":
                own = max(own, -DOUBT)  # form and context can carry letters that the sample knows nothing of
            elif votes[2] == "n":
                own = min(own, DOUBT)
            own += self._score(2, (c[5], c[6]), around_features)
        return score + own > 0

    def read(self, text: str) -> list[tuple[str, int, int]]:
        return self.mentions(candidates(text, self.ordinary))

    def mentions(self, found: list[Candidate]) -> list[tuple[str, int, int]]:
        """(type, start, end) of one text, in order, without overlaps."""
        accepted: list[list[tuple[int, int]]] = [[] for _ in TYPES]
        names = []
        for c in found:
            if c[0] == NAME:
                names.append(c)
            elif self.accepts(c, c[4]):
                accepted[c[0]].append((c[1], c[2]))
        ok, before = [], False
        for c in names:
            before = self.accepts(c, name_votes(c, self.lexicon, c[8] and before))
            ok.append(before)
        for i in range(len(names) - 2, -1, -1):  # and backwards, from a name to the word before it
            if ok[i + 1] and not ok[i] and names[i + 1][8]:
                ok[i] = self.accepts(names[i], name_votes(names[i], self.lexicon, True))
        for i, c in enumerate(names):
            if ok[i] and c[8] and i and ok[i - 1]:
                accepted[NAME][-1] = (accepted[NAME][-1][0], c[10])
            elif ok[i]:
                accepted[NAME].append((c[9], c[10]))
        out: list[tuple[int, int, str]] = []
        held = bytearray(max((c[10] for c in found), default=0))
        for k, kind in enumerate(TYPES):
            for s, e in accepted[k]:
                if not any(held[s:e]):
                    held[s:e] = b"\x01" * (e - s)
                    out.append((s, e, kind))
        return [(k, s, e) for s, e, k in sorted(out)]


def find_mentions(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, pii_type, start_pos, end_pos) in all documents (doc_id, text). Without a model one is fitted, and its candidates are decided on."""
    id_type = docs.schema["doc_id"].dataType
    own = model is None
    model = model or Model(docs)
    decide, arrow_id = model.decider(), to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                docs, what = b.column(0).slice(at, 1000).to_pylist(), b.column(1).slice(at, 1000)
                each = map(decide.mentions, found_in(what)) if own else (decide.read(t) if t else [] for t in what.to_pylist())
                rows = [(doc, *x) for doc, mentions in zip(docs, each, strict=True) for x in mentions]
                columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (arrow_id, pa.string(), pa.int32(), pa.int32()), strict=True)], names=["doc_id", "pii_type", "start_pos", "end_pos"])

    return (model.cut if own else docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {id_type.simpleString()}, pii_type string, start_pos int, end_pos int")


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, text) with every mention replaced by its type in brackets, the rest as it is."""
    decide = (model or Model(docs)).decider()

    def one(text: str) -> str:
        out, at = [], 0
        for k, s, e in decide.read(text):
            out += [text[at:s], f"[{k.upper()}]"]
            at = e
        return "".join([*out, text[at:]])

    @F.pandas_udf(T.StringType())
    def placed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: one(t) if t else t)

    return docs.withColumn("text", placed("text")).select("doc_id", "text")
