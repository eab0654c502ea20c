"""Plain loops over small inputs, to check the joins against."""

import math
import re
from collections import Counter, defaultdict


def similarity(a, b):
    longer = max(len(a), len(b))
    if longer == 0:
        return 1.0
    return 1 - (longer - sum(x == y for x, y in zip(a, b, strict=False))) / longer


def label_words(text):
    return re.findall(r"[^\W_]+", text.lower())


def search(mentions, labels, size):
    """{mention: [(kb_id, label, score)]} by scoring every label for every mention."""
    labels = sorted(set(labels))
    df = Counter(w for _, label in labels for w in set(label_words(label)))
    out = {}
    for mention in set(mentions):
        hits = []
        for kb_id, label in labels:
            shared = set(label_words(mention)) & set(label_words(label))
            if shared:
                n = len(label_words(label))
                total = sum(1 + math.log(len(labels) / (df[w] + 1)) for w in shared)
                hits.append((-round(total / math.sqrt(n), 6), n, kb_id, label))
        if hits:
            out[mention] = [(kb_id, label, -score) for score, _, kb_id, label in sorted(hits)[:size]]
    return out


def lemma(word, lexicon, endings, exceptions=None):
    """Shortest known form of the nearest level, the levels being sets of forms ever more rules away."""

    def levels():
        if exceptions and word in exceptions:
            yield [word, *exceptions[word]]
            return
        level, extra = [word], [word]
        while level:
            level = [f.removesuffix(old) + new for f in level for old, new in endings if f.endswith(old)]
            yield extra + level
            extra = []

    for level in levels():
        if known := sorted((f for f in level if f in lexicon), key=len):
            return known[0]
    return word


def strip_code_blocks(text):
    """Lines that are no mark and whose last mark before them, if any, is a closing one."""
    lines = text.splitlines()
    marks = ["open" if x[:4] == "<!--" else "close" if x[:5] == "//-->" else None for x in lines]
    last = [next((m for m in reversed(marks[:i]) if m), "close") for i in range(len(lines))]
    return " ".join(x for x, mark, before in zip(lines, marks, last, strict=True) if mark is None and before == "close")


def scores(bags, nouns, pairs, threshold=0.8):
    return {
        (doc, kb): sum(similarity(a, b) > threshold for a in bags[doc] for b in nouns.get(kb, [])) / len(bags[doc]) for doc, kb in pairs
    }


def label_sets(hits):
    sets = defaultdict(set)
    for kb_id, label, _ in hits:
        sets[kb_id].add(label)
    return dict(sets)


def html_text(markup, sep=" "):
    """Text nodes by a walk over the letters; see the scanner for what is dropped."""
    out, i, n = [], 0, len(markup)

    def tag_end(i):
        while i < n and markup[i] != ">":
            if markup[i] == "=":
                j = i + 1
                while j < n and markup[j] in " \t\n\x0b\f\r":
                    j += 1
                if j < n and markup[j] in "\"'" and markup.find(markup[j], j + 1) >= 0:
                    i = markup.find(markup[j], j + 1)
            i += 1
        return min(i + 1, n)

    while i < n:
        rest = markup[i:].lower()
        if rest.startswith("<!--"):
            ends = [m.end() for p in ("-->", "--!>") for m in [re.compile(re.escape(p)).search(markup, i + 4)] if m]
            i += 5 if rest[4:5] == ">" else 6 if rest[4:6] == "->" else min(ends, default=n) - i
            out.append(sep)
        elif re.match(r"<(script|style)[\s/>]", rest, re.ASCII) and markup[tag_end(i + 2) - 1] == ">":
            name = re.match(r"<(script|style)", rest)[1]
            start = tag_end(i + 1 + len(name))
            close = re.compile(rf"</{name}(?:[\s/][^>]*)?>", re.I | re.ASCII).search(markup, start)
            i = close.end() if close else n
            out.append(sep)
        elif re.match(r"</?[a-z]", rest):
            i = tag_end(i + 2)
            out.append(sep)
        elif re.match(r"<[!?/]", rest):
            i = markup.find(">", i) + 1 or n
            out.append(sep)
        else:
            out.append(markup[i])
            i += 1
    return "".join(out)
