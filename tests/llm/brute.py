"""Plain versions of the operators, slow and simple, to hold the results against."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")


def fold(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def shingle_set(text, k):
    found = WORD.findall(fold(text or ""))
    if not found:
        return frozenset()
    if len(found) < k:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[i : i + k]) for i in range(len(found) - k + 1))


def least_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_components(rows, k=3, num=90, den=100):
    """``rows``: (doc_id, text) with distinct ids; gives {doc_id: (set size, component)}."""
    sets = {i: shingle_set(t, k) for i, t in rows}
    classes = defaultdict(list)
    for i, s in sets.items():
        classes[s].append(i)
    holders = defaultdict(list)
    common = defaultdict(int)
    links = [(min(ids), i) for s, ids in classes.items() if s for i in ids]
    for s, ids in classes.items():
        for x in s:
            for other in holders[x]:
                common[other, min(ids)] += 1
            holders[x].append(min(ids))
    for (a, b), c in common.items():
        if den * c >= num * (len(sets[a]) + len(sets[b]) - c):
            links.append((a, b))
    comp = least_reachable(sets, links)
    return {i: (len(s), comp[i]) for i, s in sets.items()}


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle_manifest(rows, fanout=2, every=7):
    """``rows``: dicts of documents with distinct ids or rows; gives a list of manifest rows."""

    def leaf(d, n_chars):
        values = (d["doc_id"], d["source"], d["lang"], n_chars, d["text"])
        return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
        return out

    def siblings(tree, k):
        for nodes in tree[:-1]:
            run = nodes[k - k % fanout : k - k % fanout + fanout]
            yield run[: k % fanout], run[k % fanout + 1 :]
            k //= fanout

    by_lang = defaultdict(list)
    for d in rows:
        by_lang[d["lang"]].append(d)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, leaf(d, d["n_chars"])))
        trees[lang] = levels([leaf(d, d["n_chars"]) for d in by_lang[lang]])
    top = levels([trees[lang][-1][0] for lang in langs])
    out = []
    for j, lang in enumerate(langs):
        for k, d in enumerate(by_lang[lang]):
            path = [*siblings(trees[lang], k), *siblings(top, j)]
            n_chars = d["n_chars"]
            if d["doc_id"] is not None and n_chars is not None and zlib.crc32(str(d["doc_id"]).encode()) % every == 0:
                n_chars += 1
            node = leaf(d, n_chars)
            for left, right in path:
                node = digest(*left, node, *right)
            proof = digest(*[x for left, right in path for x in left + right])
            out.append((d["doc_id"], trees[lang][0][k], trees[lang][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def prefix_trie(rows, family=5, heads=9):
    """``rows``: (conv_id, turn, role, text); gives the node rows."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    told = {}
    for conv in own:
        own[conv].sort()
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % heads
        told[conv] = [t[2:] for t in own.get(conv - conv % family, [])[:h] + own[conv][h:]]
    members = defaultdict(list)
    for conv, turns in sorted(told.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[c] for c in below) if below else 1
        saved[node] = sum(saved[c] for c in below) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        ends = ",".join(str(c) for c in members[node] if len(told[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.append((members[node][0], len(node), parent, len(members[node]), len(below), leaves[node], saved[node], digest(ends)))
    return out
