"""Plain Python versions shared by tests."""

import collections
import itertools
import re


def quality_keeps(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    count = collections.Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if count[w] > 1 for j in range(5)}
    return len(words) >= 10 and 100 * len(covered) <= 20 * len(words)


def similar_groups(texts, percent):
    """The smallest id of each group of similar texts."""
    sets = {}
    for i, t in texts.items():
        words = (t or "").lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in itertools.combinations(sets, 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {find(i) for i in sets}
