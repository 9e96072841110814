"""Plain Python statements of the folds, to check the jobs against."""

import math
import re

from docloom import constants as K

STRIP = K.SPACES


def words(t):
    return t.split()


def sentences(t):
    return [s for s in (p.strip(STRIP) for p in re.findall(K.SENTENCE.replace(r"\z", r"\Z"), t)) if s]


def pack(items, limit, glue, size=lambda t: len(words(t))):
    out, cur, n = [], [], 0
    for it in items:
        k = size(it)
        if cur and n + k > limit:
            out.append(glue.join(cur))
            cur, n = [], 0
        cur.append(it)
        n += k
    return out + ([glue.join(cur)] if cur else [])


def structure_chunks(text, limit):
    if not text:
        return []
    if len(words(text)) <= limit:
        return [text]
    for pattern in K.HEADER_PATTERNS:
        starts = [m.start() for m in re.finditer(pattern, text) if m.end() > m.start()]
        cuts = [0, *starts, len(text)]
        parts = [p for p in (text[a:b].strip(STRIP) for a, b in zip(cuts, cuts[1:])) if p]
        if len(parts) > 1:
            return [c for p in parts for c in structure_chunks(p, limit)]
    paragraphs = [p for p in (x.strip(STRIP) for x in re.split(r"\n\s*\n", text)) if p]
    if len(paragraphs) > 1:
        return [c for p in pack(paragraphs, limit, "\n\n") for c in structure_chunks(p, limit)]
    out, cur, n = [], [], 0
    for s in sentences(text):
        k = len(words(s))
        if n + k <= limit or (not cur and k <= limit):
            cur.append(s)
            n += k
            continue
        if cur:
            out.append(" ".join(cur))
        cur, n = ([s], k) if k <= limit else ([], 0)
        if k > limit:
            for w in words(s):
                if cur and n + 1 > limit:
                    out.append(" ".join(cur))
                    cur, n = [], 0
                cur.append(w)
                n += 1
    return out + ([" ".join(cur)] if cur else [])


def score(s):
    counts = {}
    for t in re.findall(r"\w+", s.lower()):
        counts[t] = counts.get(t, 0) + 1
    return math.sqrt(sum(c * c for c in counts.values()))


def select(text, lower, upper):
    ss = sentences(text)
    if not ss:
        return ""
    scores = [score(s) for s in ss]
    kept, n = [], 0
    for i in sorted(range(len(ss)), key=lambda i: (-scores[i], i)):
        k = len(words(ss[i]))
        if kept and n >= lower and (scores[i] < scores[0] * 0.5 or n >= upper):
            break
        if not kept or n + k <= upper * 1.1:
            kept.append(i)
            n += k
    return " ".join(ss[i] for i in sorted(kept))


def share(k):
    return K.CHUNK_SHARES[k - 1] if k <= len(K.CHUNK_SHARES) else K.DEFAULT_SHARE


def extract(chunk, k):
    n = len(words(chunk))
    target = n if n <= 600 else int(n * share(k))
    v = 0.25 if k <= 2 else 0.2
    return select(chunk, int(target * (1 - v)), int(target * (1 + v)))


def extract_share(chunk, p, v=0.25):
    n = len(words(chunk))
    return select(chunk, int(n * (p * (1 - v))), int(n * (p * (1 + v))))


def reduce_to(text, target):
    n = len(words(text))
    if n <= target * 1.5:
        return text
    r = target / n
    return select(text, int(n * max(0.15, r * 0.75)), int(n * max(0.15, r * 1.25)))


def bounds(n):
    for top, lo, hi in K.SHORT_SUMMARY:
        if n <= top:
            return lo, hi
    if n <= 2500:
        k = max(300, min(int(0.3 * n), 600))
        return int(0.6 * k), int(0.8 * k)
    return (480, 600) if n <= 20000 else (600, 800)


def summary(text):
    n = len(words(text))
    if n == 0:
        return None
    tier = 1 if n <= 600 else 2 if n <= 2500 else 3 if n <= 20000 else 4
    if tier == 1:
        e = text
    elif tier == 2:
        e = " ".join(extract(c, i) for i, c in enumerate(structure_chunks(text, 514), 1))
    else:
        e = " ".join(extract_share(c, share(i)) for i, c in enumerate(pack(sentences(text), 1000, " "), 1))
        while (shorter := reduce_to(e, K.PASS_TARGET[tier])) != e:
            e = shorter
    lo, hi = bounds(len(words(e)) if tier <= 2 else n)
    model = "LongformerBART" if tier == 4 else "BART"
    return f"[{model} summary ({lo}-{hi} words)]: " + " ".join(words(e)[:lo]) + "..."
