"""Plain-Python versions of the operators' results, by definition and without their methods."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def words(text):
    return WORD.findall(text or "")


def lower_words(text):
    return WORD.findall((text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def token_rows(rows, name, end_id):
    """[(doc_id, start, n_tokens, crc32)] in order of doc_id (None first)."""
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def base_measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    places = defaultdict(list)
    for i in range(len(w) - 4):
        places[tuple(w[i:i + 5])].append(i)
    hit = {i + j for at in places.values() if len(at) > 1 for i in at for j in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def rule_rejects(text):
    n, chars, symbols, dup, rep = base_measures(text)
    w, lines = words(text), [x for x in (text or "").split("\n") if WORD.search(x)]
    upper = sum("A" <= c <= "Z" for c in text or "")
    letters = sum(("a" <= c.lower() <= "z" and c < "\x80") or c >= "\x80" for c in text or "")
    top = max(Counter(w).values(), default=0)
    return (n < 10 or 100 * rep > 20 * n or 4 * symbols > n or 2 * dup > len(lines) or 10 * upper > 7 * letters
            or 10 * letters < 4 * chars or chars < 2 * n or chars > 20 * n or 2 * top > n)


def shingle_set(text, width):
    w = lower_words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def near_duplicates(rows, width, percent=80):
    """{doc_id: component_id} over all pairs."""
    sets = [(d, shingle_set(t, width)) for d, t in rows if d is not None]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in root}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def pii(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                  "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def redacted(text):
    """The text with the union of overlapping spans replaced by the first one's kind."""
    if not text:
        return text
    runs = []
    for s, e, kind in sorted((s, e, k) for k, s, e in pii(text)):
        if runs and s < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], e)
        else:
            runs.append([s, e, kind])
    out, at = "", 0
    for s, e, kind in runs:
        out += text[at:s] + f"<{kind.upper()}>"
        at = e
    return out + text[at:]


def kept_words(rows, size=13):
    """[(doc_id, n_words, n_removed, sha256 of the kept words)] in the order of ``rows``; no id counts as the largest."""
    big = float("inf")
    least = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - size + 1):
            k = tuple(w[i:i + size])
            least[k] = min(least.get(k, big), big if d is None else d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - size + 1):
            if least[tuple(w[i:i + size])] < (big if d is None else d):
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def contamination(text, items, size=13):
    """n_words, n_hit, sorted ids of the items that occur"""
    w = BENCH_WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, t in items:
        v = BENCH_WORD.findall((t or "").translate(LOWER))
        m = min(len(v), size)
        wins = {tuple(v[i:i + m]) for i in range(len(v) - m + 1)} if m else set()
        for i in range(len(w) - m + 1) if m else ():
            if tuple(w[i:i + m]) in wins:
                hit.update(range(i, i + m))
                found.add(item)
    return len(w), len(hit), sorted(str(i) for i in found if i is not None)


def bpe(text, name="byte_bpe_50k.json", tok={}):
    t = tok.setdefault(name, Tokenizer.from_file(public_tokenizers.path(name)))
    ids = t.encode(text or "", add_special_tokens=False).ids
    return len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))
