"""Shapes of personal data in running text: addresses, mail, numbers, names.

Every pattern is generic for its kind and written for text that may be upper case,
doubly spaced, decomposed or read in the wrong encoding (two characters for one letter).
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

import regex

#: A letter, also one that was read in the wrong encoding or is followed by marks.
L = r"(?:(?:[ÃÂ][\u0080-¿ŒœŠšŸŽžƒˆ˜–-›€™]|\p{L})\p{M}*)"
UP = r"(?:(?:Ã[\u0080-\u009fŒœŠšŸŽžƒˆ˜–-›€™]|\p{Lu})\p{M}*)"
S = r"[ \t  ]"
#: A space inside of a value, also doubled; in an address also one line break.
G = rf"(?:{S}+)"
SP = rf"(?:{S}*\n{S}*|{S}+)"

_AT = rf"{S}?(?:@|[(\[]{S}?(?:at|AT){S}?[)\]]){S}?"
_DOT = rf"(?:\.|{S}?[(\[]{S}?(?:dot|DOT|punkt|PUNKT){S}?[)\]]{S}?)"
_LOCAL = r"(?<![\p{L}\p{N}._%+@-])[\p{L}\p{N}](?:[\p{L}\p{N}\p{M}_%+-]|\.(?=[\p{L}\p{N}]))*+"
_HOST = r"[\p{L}\p{N}](?:[\p{L}\p{N}-]*[\p{L}\p{N}])?"
EMAIL = regex.compile(rf"{_LOCAL}(?:{_AT}{_HOST}(?:{_DOT}{_HOST})+|{S}(?:AT|at){S}{_HOST}(?:{S}(?:DOT|dot){S}{_HOST})+)")
#: A text without any of these holds no address of this kind.
EMAIL_HINTS = ("@", *(a + s + t for a in "([" for s in ("", *" \t\u00a0\u202f") for t in ("at", "AT")), *(a + t + b for t in ("DOT", "dot") for a in " \t\u00a0\u202f" for b in " \t\u00a0\u202f"))

_SEP = rf"(?:{G}|[./-])?"
PHONE = regex.compile(
    rf"(?<![\p{{L}}\p{{N}}+./:,-])(?:"
    rf"(?:\+|00)[1-9]\d{{0,2}}{_SEP}(?:\(0\){_SEP})?\(?\d{{1,5}}\)?(?:{_SEP}\d{{1,8}}){{1,5}}"  # international
    rf"|\(0\d{{1,4}}\)(?:{_SEP}\d{{1,8}}){{1,5}}"  # (area) number
    rf"|\([2-9]\d\d\){_SEP}\d{{3}}{_SEP}\d{{4}}|[2-9]\d\d(?P<d>[.-])\d{{3}}(?P=d)\d{{4}}"  # ten digits in threes
    rf"|(?=(?:[ \t\u00a0\u202f./-]{{0,3}}\d){{9}})0[1-9]\d{{0,4}}(?:{G}|[./-])\d{{2,8}}(?:{_SEP}\d{{1,8}}){{0,4}}"  # area, number
    rf"|0[1-9]\d{{8}}"
    rf")(?![\p{{L}}\p{{N}}]|[./:,-]\d)"
)



def _groups(*sizes: int) -> str:
    """Digits in groups: all of them apart, or none."""
    return "(?:" + G.join(rf"\d{{{n}}}" for n in sizes) + rf"|\d{{{sum(sizes)}}})"


ID = regex.compile(
    rf"(?<![\p{{L}}\p{{N}}.,:/@_-])(?:"
    rf"[A-Za-z]{{2}}\d{{2}}(?:{G}?[A-Za-z0-9]{{4}}){{3,7}}(?:{G}?[A-Za-z0-9]{{1,3}})?(?<=\d)"  # bank account
    rf"|\d{{2}}{G}?\d{{6}}{G}?[A-Za-z]{G}?\d{{3}}"  # pension insurance
    rf"|{_groups(1, 2, 2, 2, 3, 3, 2)}|{_groups(1, 2, 2, 2, 3, 3)}"  # social security, 15 or 13
    rf"|{_groups(2, 3, 3, 3)}"  # tax number of 11 digits
    rf"|\d{{3}}-\d{{2}}-\d{{4}}"  # social security, 9
    rf"|[A-Za-z]{{2}}{G}?{_groups(2, 2, 2)}{G}?[A-Da-d]"  # national insurance
    rf"|[A-Za-z]{{2}}\d{{2}}[A-Za-z]\d{{3}}[A-Za-z]|\d{{2}}[A-Za-z]{{2}}\d{{5}}"  # identity card
    rf")(?![\p{{L}}\p{{N}}]|[./:,-]\d)"
)

_ORT = rf"{UP}{L}*(?:[-']{L}+)*"
_NR = r"\d{1,4}(?:[A-Da-d](?!\p{L}))?"
_DE_STREET = (
    rf"(?:(?:Am|Im|Zum|An der|Zur|AM|IM|ZUM|AN DER|ZUR){SP}{UP}{L}*?(?:graben|ufer|hang|rain|weg|berg|bach|hof|park|markt|tor|see|wall|damm|anger|ring|platz|steg|garten|GRABEN|UFER|HANG|RAIN|WEG|BERG|BACH|HOF|PARK|MARKT|TOR|SEE|WALL|DAMM|ANGER|RING|PLATZ|STEG|GARTEN)"
    rf"|{UP}{L}*?(?:stra(?:ss|ß|ÃŸ|Ã\u009f)e|str\.|weg|gasse|allee|platz|ring|stieg|ufer|graben|damm|pfad|hof|STRASSE|STRAßE|STR\.|WEG|GASSE|ALLEE|PLATZ|RING|STIEG|UFER|GRABEN|DAMM|PFAD|HOF))"
)
_DE_TOWN = rf"(?:D-|DE-)?\d{{5}}{SP}{_ORT}"
_EN_STREET = (
    rf"{UP}{L}+(?:{SP}{UP}{L}+)?{SP}(?:Street|St\.?|Road|Rd\.?|Avenue|Ave\.?|Lane|Ln\.?|Close|Mews|Drive|Dr\.?|Way|Court|Ct\.?|Place|Pl\.?|Terrace|Gardens|Row|Square|Sq\.?|Crescent|Hill|Walk|Grove"
    rf"|STREET|ST\.?|ROAD|RD\.?|AVENUE|AVE\.?|LANE|LN\.?|CLOSE|MEWS|DRIVE|WAY|COURT|PLACE|TERRACE|GARDENS|ROW|SQUARE|CRESCENT|HILL|WALK|GROVE)(?!\p{{L}})"
)
_EN_CODE = rf"[A-Z]{{1,2}}\d{{1,2}}[A-Z]?{SP}\d[A-Z]{{2}}"
_FR_STREET = (
    rf"(?:rue|avenue|boulevard|allée|allÃ©e|allée|impasse|chemin|place|quai|cours|route|ruelle|square|RUE|AVENUE|BOULEVARD|ALLÉE|ALLÉE|IMPASSE|CHEMIN|PLACE|QUAI|COURS|ROUTE|RUELLE|SQUARE)"
    rf"(?:{SP}(?:de|du|des|la|le|les|DE|DU|DES|LA|LE|LES))*(?:{SP}[dlDL]['’])?(?:{SP}?{UP}{L}+(?:-{L}+)*){{1,3}}"
)
_JOIN = rf"(?:,?{SP}|{SP}?,{SP}?)"
ADDRESS = regex.compile(
    rf"(?<![\p{{L}}\p{{N}}-])(?:"
    rf"{_DE_STREET}{SP}{_NR}(?:(?:{_JOIN}|{SP}in{SP}|{SP}IN{SP}){_DE_TOWN})?"
    rf"|{_NR}{SP}{_EN_STREET}(?:{_JOIN}(?:{_ORT}{_JOIN})?{_EN_CODE})?"
    rf"|{_NR}(?:{SP}?(?:bis|ter|BIS|TER))?{_JOIN}{_FR_STREET}(?:{_JOIN}\d{{5}}{SP}{_ORT})?"
    rf")(?![\p{{N}}])"
)

#: Words of address in the corpus' languages: what is known beforehand; all else that announces a person is learned.
TITLES = frozenset("Herr Herrn Frau Mr Mrs Ms Miss Mme Mlle Monsieur Madame Dr Prof M HERR HERRN FRAU MONSIEUR MADAME".split())
_W = rf"(?:{UP}['’])?{UP}{L}+"
_LAST = rf"{_W}(?:-{_W})*"
_INI = rf"{UP}\."
#: Given [initial] family | initial family | family, given [initial].
NAME = regex.compile(
    rf"(?<![\p{{L}}\p{{N}}@._'’-])(?:(?P<last>{_LAST}),{G}(?P<first>{_LAST}|{_INI})(?:{G}{_INI})?"
    rf"|(?P<first>{_LAST})(?:{G}{_INI})?{G}(?P<last>{_LAST})|(?P<first>{_INI}){G}(?P<last>{_LAST}))(?![\p{{L}}\p{{N}}@]|-\p{{L}})"
)
_PARTICLE = (
    rf"(?:(?:(?:von|van|vom|zu|zur|de|di|da|del|della|dos|ten|ter|VON|VAN|VOM|ZU|ZUR|DE|DI|DA|DEL|DELLA|DOS|TEN|TER)"
    rf"(?:{SP}(?:der|den|dem|la|las|le|los|zu|DER|DEN|DEM|LA|LAS|LE|LOS|ZU))?|du|le|la|DU|LE|LA){SP}|[dD]['’])"
)
PARTICLE = regex.compile(_PARTICLE)
#: Several given or family words, particles, and one line break; "," after the first as above.
LONG = regex.compile(
    rf"(?<![\p{{L}}\p{{N}}@._'’-])(?:(?P<first>{_LAST}|(?!M\.){_INI})(?:{SP}{_INI}|{SP}(?P<part>{_PARTICLE})?(?P<word>{_LAST})(?![\p{{L}}\p{{N}}@]|-\p{{L}})){{1,4}}"
    rf"|(?P<last>(?:{_PARTICLE})?{_LAST}),{SP}(?P<given>{_LAST})(?:{SP}(?P<more>{_LAST}|{_INI}))*(?![\p{{L}}\p{{N}}@]|-\p{{L}}))"
)
_FIRST = ("von", "van", "vom", "zu", "zur", "de", "di", "da", "del", "della", "dos", "ten", "ter", "du", "le", "la")
_SECOND = ("der", "den", "dem", "la", "las", "le", "los", "zu")
#: A run that begins with no small ASCII letter, in front of another such run or of a particle and one.
_BIG = r"[^\Wa-z\d_]"
_PAIR = re.compile(rf"{_BIG}(?:\S|(?<=[ÃÂ])[\x85\xa0])*\s+(?=(?:(?:{'|'.join(_FIRST)})\s+(?:(?:{'|'.join(_SECOND)})\s+)?|d['’])?{_BIG})")
_INNER = re.compile(rf"(?<=[^\w@.'’-]){_BIG}")


def pair_starts(text: str):
    """Where a pair of capitalised words may begin, in order: every start of NAME and LONG is one."""
    for m in _PAIR.finditer(text):
        i, token = m.start(), m.group()
        if "," in token:  # the family name first, perhaps with a particle
            if text[i - 1 : i] in ("'", "’") and i > 1:
                yield i - 2
            elif (j := back(text, i)) > 0:
                w = _word(text, j)
                if text[w:j] in _SECOND and (k := back(text, w)) > 0 and text[(v := _word(text, k)) : k] in _FIRST:
                    yield v
                if text[w:j] in _FIRST:
                    yield w
        yield i
        if not token.rstrip().isalpha():
            for x in _INNER.finditer(text, i + 1, m.end()):
                yield x.start()


def goes_on(text: str, at: int) -> bool:
    """Spaces, and then a capital letter or what may begin a particle."""
    n = len(text)
    if at >= n or not text[at].isspace():
        return False
    while at < n and text[at].isspace():
        at += 1
    return at < n and (text[at].isupper() or text[at] in "vzdtl")


_NUMBER = re.compile(r"\d+|[+(]")
_GAPS = " \t\u00a0\u202f"
_DIGIT_OR_GAP = frozenset("0123456789" + _GAPS)
_STREETS = tuple(
    x
    for w in "straße straÃŸe straÃ\u009fe strasse str. weg gasse allee platz ring stieg ufer graben damm pfad hof hang rain berg bach park markt tor see wall anger steg garten".split()
    for x in (w, w.upper())
) + ("STRAßE",)
_BEFORE = ("Am", "Im", "Zum", "Zur", "AM", "IM", "ZUM", "ZUR")
_FRENCH = tuple(x for w in "rue avenue boulevard allée allÃ©e alle\u0301e impasse chemin place quai cours route ruelle square bis ter".split() for x in (w, w.upper()))


def back(text: str, i: int) -> int:
    """The end of what stands before ``i`` and spaces with at most one line break; -1 if nothing separates."""
    j, breaks = i, 0
    while j and (text[j - 1] in _GAPS or text[j - 1] == "\n" and not breaks):
        j -= 1
        breaks += text[j] == "\n"
    return j if j < i else -1


def _word(text: str, j: int) -> int:
    """Start of the run of letters (and marks, and letters in the wrong encoding) that ends at ``j``."""
    while j:
        c = text[j - 1]
        if c.isalpha() or unicodedata.combining(c) or c == "." or j > 1 and text[j - 2] in "ÃÂ" and not c.isspace():
            j -= 1
        else:
            break
    return j


def _starts(text: str):
    """Positions at which an id, an address or a phone number may begin, from the numbers in the text."""
    ids, places, phones = [], [], []
    for m in _NUMBER.finditer(text):
        i, e = m.span()
        c, before = text[i], text[i - 1 : i]
        if not c.isdigit():
            phones.append(i)
            continue
        n, after = e - i, text[e : e + 1]
        if c == "0" or n == 3 and after in ".-":
            phones.append(i)
        if before.isalpha():
            if text[i - 2 : i].isalpha():
                ids.append(i - 2)
            continue
        # one or two digits go on with digits after a space, two also with letters
        if n > 3 or n == 3 and after == "-" or n == 2 and after.isalpha() or n < 3 and after and after in _GAPS and text[e + 1 : e + 2] in _DIGIT_OR_GAP:
            ids.append(i)
        if n > 1 and before and before in _GAPS:  # two letters, a space, digits
            j = len(text[:i].rstrip(_GAPS)) if text[i - 2 : i - 1] in _GAPS else i - 1
            if text[j - 2 : j].isalpha() and not text[j - 3 : j - 2].isalpha():
                ids.append(j - 2)
        if n > 4:
            continue
        if before and (before in _GAPS or before == "\n"):
            j = back(text, i)
            if text.endswith(_STREETS, 0, j):
                w = _word(text, j)
                k = back(text, w)
                if k > 0:
                    if text.endswith(_BEFORE, 0, k):
                        places.append(_word(text, k))
                    elif text.endswith(("der", "DER"), 0, k) and (a := back(text, k - 3)) > 0 and text.endswith(("An", "AN"), 0, a):
                        places.append(a - 2)
                while w < j and not text[w].isupper():
                    w += 1
                places.append(w)
        j = e + (after != "" and after in "ABCDabcd" and not text[e + 1 : e + 2].isalpha())
        if text[j : j + 1] != "" and (text[j] in _GAPS or text[j] in ",\nbtBT"):
            while j < len(text) and (text[j] in _GAPS or text[j] in ",\n"):
                j += 1
            if text[j : j + 1].isupper() or text.startswith(_FRENCH, j):
                places.append(i)
    return sorted(ids), sorted(places), phones


def spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of everything but names: (start, end, type), without overlaps, in order.

    Patterns are tried only where their first number allows it: long texts cost no more per letter than short ones.
    """
    ids, places, phones = _starts(text)
    begins, ends, kinds = [], [], []
    for kind, rx, at in (("email", EMAIL, None), ("id", ID, ids), ("address", ADDRESS, places), ("phone", PHONE, phones)):
        if at is None:
            hits = [m.span() for m in rx.finditer(text)] if any(x in text for x in EMAIL_HINTS) else []
        else:
            hits, free = [], 0
            for i in at:
                if i >= free and (m := rx.match(text, i)):
                    hits.append(m.span())
                    free = m.end()
        for a, b in hits:
            k = bisect_right(begins, a)
            if (not k or ends[k - 1] <= a) and (k == len(begins) or b <= begins[k]):
                begins.insert(k, a)
                ends.insert(k, b)
                kinds.insert(k, kind)
    return list(zip(begins, ends, kinds))
