"""Plain versions that the operators are held against."""

import re
from collections import Counter

import xxhash

ASSIGN = re.compile(
    r"((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, copies = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + d for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for d in range(3)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(inside)]


def plain_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    votes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))


def classes(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                root[find(a)] = find(b)
    out = {}
    for n in nodes:
        out.setdefault(find(n), set()).add(n)
    return sorted(map(sorted, out.values()))


def distance(item, text):
    before = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (a != b)))
        before = now
    return min(before)


def item_words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
