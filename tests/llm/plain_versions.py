"""Plain versions of the contracts, one text or pair at a time."""

import hashlib
import re
from collections import Counter


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def substring(rows, length=13):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - length + 1):
            k = tuple(w[i : i + length])
            first[k] = min(d, first.get(k, d))
    out = []
    for d, w in words:
        gone = {i + k for i in range(len(w) - length + 1) if first[tuple(w[i : i + length])] < d for k in range(length)}
        out.append((d, len(w), len(gone), sha(b" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def suffix_array(rows, length=200):
    bodies = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(b[i : i + length] for _, b in bodies for i in range(len(b) - length + 1))
    out = []
    for d, b in bodies:
        gone = {i + k for i in range(len(b) - length + 1) if count[b[i : i + length]] > 1 for k in range(length)}
        spans = sum(i - 1 not in gone for i in gone)
        out.append((d, len(b), len(gone), spans, sha(bytes(x for i, x in enumerate(b) if i not in gone))))
    return out


def shingle_set(text, width=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def near_duplicates(rows):
    sets = [(d, shingle_set(t)) for d, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least[find(i)], d == least[find(i)]) for i, (d, s) in enumerate(sets)]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def digits(x):
    return re.sub("[^0-9]", "", x)


KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(digits(v)) <= 19 and luhn(digits(v))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(digits(v)) <= 15),
)


def pii(rows):
    out = []
    for d, t in rows:
        found = [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, t or "") if ok(m[0])] for k, p, ok in KINDS]
        out.append((d, *map(len, found), sha(",".join(x for f in found for x in f).encode())))
    return out


def license_base(rows):
    out = []
    for d, t in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        at = {label: [i for i in range(len(w)) if w[i : i + len(p)] == p] for p, label in ((["mit", "license"], "mit"), (["apache", "license"], "apache"), (["general", "public", "license"], "gpl"))}
        every = sorted(i for v in at.values() for i in v)
        out.append((d, len(w), len(every), every[0] if every else None, every[-1] if every else None, ",".join(sorted(k for k, v in at.items() if v))))
    return out


def quality(rows):
    out = []
    for d, t in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines, seen, dup = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)], set(), 0
        for x in lines:
            dup += x in seen
            seen.add(x)
        count = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        repeat = {i + k for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for k in range(3)}
        out.append((d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(repeat), len(w) < 50 or 100 * len(repeat) > 50 * len(w)))
    return out


def line_chunks(rows, chunks, words=8):
    """Texts without repeated multi-line chunks; ``chunks`` gives the boundaries."""
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: r[0]):
        lines, kept = (t or "").split("\n"), []
        for a, b in chunks([x.encode() for x in lines]):
            c = "\n".join(lines[a:b])
            if b - a >= 2 and len(c.encode().split()) >= words:
                if c in seen:
                    continue
                seen.add(c)
            kept += lines[a:b]
        out.append((d, "\n".join(kept)))
    return out


def weighted(a, b, width=5):
    x, y = (Counter(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) for w in (a, b))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def leaks(rows, items, words_of):
    """(document, item) pairs by comparing every window with every item; a document shorter than an item is one window."""
    out = set()
    for d, t in rows:
        w = words_of((t or "").encode())
        for k, text in items:
            v = words_of((text or "").encode())
            width = min(5, len(v))
            if v and any(weighted(w[i : i + len(v)], v, width) >= 0.75 for i in range(max(1, len(w) - len(v) + 1))):
                out.add((d, k))
    return out


def folded_words(body):
    """Runs of letters, digits and characters over 0x7F, in small letters, without the operator's own code."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", body.decode("utf-8", "replace").lower())


def license_labels(text, templates):
    """Templates accepted somewhere in a text: each as one regular expression over words that end in a space."""
    words = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x))
    flat = "".join(w + " " for w in words(text))
    found = set()
    for label, t in templates.items():
        pattern = ""
        for part in re.split(r"(<<.*?>>)", t):
            match = re.search('match="([^"]*)"', part)
            if part == "<<beginOptional>>":
                pattern += "(?:"
            elif part == "<<endOptional>>":
                pattern += ")?"
            elif part.startswith("<<var"):
                choices = []
                for c in match[1].split("|"):
                    gap = re.fullmatch(r"\.(\+|\{.*\})", c)
                    choices.append(rf"(?:[^ ]+ ){gap[1]}" if gap else "".join(re.escape(w) + " " for w in words(c)))
                pattern += "(?:" + "|".join(choices) + ")"
            else:
                pattern += "".join(re.escape(w) + " " for w in words(part))
        if re.search("(?:^|(?<= ))" + pattern, flat):
            found.add(label)
    return found


def inside_bands(body, bands):
    """The compression verdict of a text, step by step."""
    import zstandard

    ratio = lambda x: len(zstandard.ZstdCompressor(level=bands.level).compress(x)) / len(x)
    if not body:
        return True
    fitting = [(low, high) for least, low, high in bands.whole if least <= len(body)]
    if fitting and not fitting[-1][0] <= ratio(body) <= fitting[-1][1]:
        return False
    if len(body) < bands.chunk_bytes:
        return True
    ends = [*range(bands.chunk_bytes, len(body), bands.chunk_bytes), len(body)]
    out = [not bands.chunk[0] <= ratio(body[e - bands.chunk_bytes : e]) <= bands.chunk[1] for e in ends]
    return sum(out) <= bands.bad_chunks * len(out)


def repeated_lines(rows, words=8):
    """Lines of each document in a run of two or more that an earlier place has too: every place with every other."""
    split = {d: t.split("\n") for d, t in rows}
    places = sorted((d, i) for d, x in split.items() for i in range(len(x)))
    gone = {d: set() for d in split}
    for k, (d, i) in enumerate(places):
        for e, j in places[:k]:
            n = 0
            while i + n < len(split[d]) and j + n < len(split[e]) and split[d][i + n] == split[e][j + n]:
                n += 1
            if n > 1 and sum(len(x.split()) for x in split[d][i : i + n]) >= words:
                gone[d].update(range(i, i + n))
    return gone, split


def without_line_runs(rows):
    """Texts without the lines of runs that an earlier place has."""
    gone, split = repeated_lines([(d, t or "") for d, t in rows])
    return [(d, "\n".join(x for i, x in enumerate(split[d]) if i not in gone[d])) for d, _ in sorted(rows)]
