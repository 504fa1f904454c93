"""Plain-Python versions of the reports, one post at a time, for small data."""

import math
import re
from collections import Counter
from datetime import timedelta
from itertools import combinations

from chirplens.config import PAIR_STOPS, WORD_STOPS


def in_window(created_at, as_of, days=4):
    return created_at is not None and created_at.replace(microsecond=0) > as_of - timedelta(days)


def words(text, stops):
    return {w.lower() for w in re.findall(r"[A-Za-z']+", text or "")} - set(stops)


def percents(texts):
    counts = Counter(w for t in texts for w in words(t, WORD_STOPS))
    return {w: c / len(texts) for w, c in counts.items()}


def pair_counts(texts):
    return Counter(p for t in texts for p in combinations(sorted(words(t, PAIR_STOPS)), 2))


def scored_pairs(texts):
    share = percents(texts)
    return {
        (a, b): (c, c * math.log(min(1 / share[a], 1 / share[b])))
        for (a, b), c in pair_counts(texts).items()
        if a in share and b in share
    }


def top_words(texts, k=500):
    return sorted(percents(texts).items(), key=lambda x: (-x[1], x[0]))[:k]


def top_pairs(texts, k=300):
    ranked = sorted(scored_pairs(texts).items(), key=lambda x: (-round(x[1][1], 9), x[0]))
    return [(a, b, c, round(s, 9)) for (a, b), (c, s) in ranked[:k]]


def top_urls(lists, k=300):
    counts = Counter((u or "").lower() for urls in lists for u in urls or [])
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]
