"""The queries' results, row by row in plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()


def contamination(docs, benchmark, width=13):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in benchmark:
        w = cut(text)
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(item)
    sizes = {len(w) for w in windows}
    for doc_id, text in docs:
        w, hit, items = cut(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                own = windows.get(tuple(w[k : k + n]))
                if own is not None:
                    hit.update(range(k, k + n))
                    items |= own
        names = sorted(str(i) for i in items if i is not None)
        yield doc_id, len(w), len(hit), len(names), sha(",".join(names)), bool(hit) and 20 * len(hit) >= len(w)


def chats(rows):
    """``rows``: (conv_id, turn, role, text)."""
    by = defaultdict(list)
    told = "</s>[INST] ok [/INST]"
    for c, turn, role, text in [*rows, (-1, 0, "user", told), (-1, 1, "assistant", told)]:
        by[c].append((turn, role or "", text or ""))
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        yield c, len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss)


def url(text, rules, default="allow"):
    rest = text.split("://", 1)[1] if text and "://" in text else None
    host = re.split(r"[/?#]", rest, maxsplit=1)[0] if rest is not None else ""
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0] if rest is not None else ""
    host = host.translate(LOWER)
    fits = [
        (len(h + p), len(h), v == "block", h + p, v)
        for h, p, v in rules
        if h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, 0, None, default))
    return host, path, best[3], best[4]


def near(docs, width, percent):
    """(doc_id, n_shingles, component_id) for rows with distinct ids."""
    sets = {}
    for doc_id, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        n = min(width, len(w))
        sets[doc_id] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    owners = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            owners[x].append(d)
    both = Counter()
    for own in owners.values():
        both.update(combinations(sorted(own), 2))
    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def bpe(docs, path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    for doc_id, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids
        yield doc_id, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), sha(t.decode(ids, skip_special_tokens=False))


def token_file(docs, path):
    """Rows in ascending order of doc_id."""
    from tokenizers import Tokenizer

    t, start = Tokenizer.from_file(path), 0
    for doc_id, text in sorted(docs, key=lambda r: r[0]):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub(r"[^0-9]", "", m)) <= 19 and _luhn(re.sub(r"[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"[^0-9]", "", m)) <= 15),
}


def private(text):
    """Strict spans (kind, start, end), by kind and start."""
    return [
        (kind, m.start(), m.end())
        for kind, (pattern, ok) in PII.items()
        for m in re.finditer(pattern, text or "", re.ASCII)
        if ok(m.group())
    ]


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for k, x in enumerate(zip(w, w[1:], w[2:])):
        if windows[x] > 1:
            hit |= {k, k + 1, k + 2}
    n = len(w)
    return (
        n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
        n < 50 or 100 * len(hit) > 50 * n,
    )
