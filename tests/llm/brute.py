"""Plain Python versions of the operators, for small inputs."""

import hashlib
import itertools
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True, pattern=SPACED):
    text = text or ""
    return pattern.findall(text.translate(_LOWER) if lower else text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def components(docs):
    """``(doc_id, n_shingles, component_id)`` of each ``(doc_id, text)``."""
    sets = [shingles(t) for _, t in docs]
    group = list(range(len(docs)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, j in itertools.combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            group[root(j)] = root(i)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = root(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(docs, sets))]


def without_repeats(docs, window=35):
    """``(doc_id, n_words, n_removed, kept_sha256)``."""
    texts = [words(t, lower=False) for _, t in docs]
    seen = {}
    for w in texts:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for (d, _), w in zip(docs, texts):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def contamination(docs, items, window=10):
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``."""
    windows = []
    for name, text in items:
        w = words(text, pattern=ALNUM)
        k = min(len(w), window)
        if k:
            windows += [("" if name is None else str(name), tuple(w[i : i + k])) for i in range(len(w) - k + 1)]
    out = []
    for d, text in docs:
        w = words(text, pattern=ALNUM)
        hit, found = set(), set()
        for name, t in windows:
            for i in range(len(w) - len(t) + 1):
                if tuple(w[i : i + len(t)]) == t:
                    hit.update(range(i, i + len(t)))
                    found.add(name)
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def kept_lines(docs, percent=80, least=1):
    """Kept text and number of removed lines of each ``(doc_id, text)``; earlier is by id."""
    rows = []
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0, i))
    for i in order:
        for k, line in enumerate((docs[i][1] or "").split("\n")):
            rows.append((i, k, line, frozenset(words(line))))
    kept = {i: [] for i in range(len(docs))}
    removed = dict.fromkeys(range(len(docs)), 0)
    for at, (i, _, line, own) in enumerate(rows):
        gone = len(own) >= least and any(
            len(other) >= least and 100 * len(own & other) >= percent * len(own | other) for *_, other in rows[:at]
        )
        removed[i] += gone
        if not gone:
            kept[i].append(line)
    return ["\n".join(kept[i]) for i in range(len(docs))], [removed[i] for i in range(len(docs))]


def url_verdicts(pages, rules, damping=0.85, steps=20, share=0.5, threshold=1e-4):
    """``(page_id, host, path, rule, verdict)`` of ``(page_id, url, html)``."""
    link = re.compile(r"""(?i)\b(?:href|src|action)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)""")
    rows, edges, pages_of = [], set(), {}
    for page, url, html in pages:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate(_LOWER), m[2]) if m else ("", "")
        fit = [r for r, _ in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        rule = max(fit, key=len, default=None)
        said = dict(rules).get(rule)
        rows.append((page, host, path, rule, said))
        if host:
            pages_of.setdefault(host, []).append(said)
            edges |= {(host, x.translate(_LOWER)) for x in link.findall(html or "") if x.translate(_LOWER) != host}

    def spread(seeds, links):
        jump = {h: 1 - damping for h in seeds}
        score = dict(jump)
        for _ in range(steps):
            new = dict(jump)
            for a, b in links:
                if a in score:
                    new[b] = new.get(b, 0) + damping * score[a] / sum(x == a for x, _ in links)
            score = new
        return score

    most = lambda what: [h for h, said in pages_of.items() if said.count(what) > share * len(said)]
    trust, distrust = spread(most("allow"), edges), spread(most("block"), {(b, a) for a, b in edges})
    out = []
    for page, host, path, rule, said in rows:
        bad = distrust.get(host, 0) > trust.get(host, 0) and distrust.get(host, 0) > threshold
        out.append((page, host, path, rule, said or ("block" if host and bad else "allow")))
    return out
