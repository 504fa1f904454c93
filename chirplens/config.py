"""Report parameters and the two stop-word lists."""

from __future__ import annotations

import string
from dataclasses import dataclass
from datetime import datetime, timedelta

# Words left out of the analysis.
_STOP_TEXT = """
a amp an and are as at be been
but by co do for has have he her his
https if in is it me my no not of on
or rt s she so t than that the they
this to us was we what with you your
who when via
"""

# Word pairs leave out every word above and every single letter.
PAIR_STOPS = tuple(dict.fromkeys(_STOP_TEXT.split() + list(string.ascii_lowercase)))

# Word counts treat "your" and "who" as one entry, "yourwho": both words are counted, and
# only the literal token "yourwho" is left out.
WORD_STOPS = tuple(w for w in PAIR_STOPS if w not in ("your", "who")) + ("yourwho",)


@dataclass(frozen=True)
class ReportConfig:
    """One report run.  ``as_of`` is a UTC wall-clock time; the library never asks for "now"."""

    as_of: datetime
    days: int = 4
    top_words: int = 500
    top_urls: int = 300
    top_pairs: int = 300


MOST_RUNS = 50_000


@dataclass(frozen=True)
class RunGrid:
    """Evenly spaced report times, the last one at ``end``: one job instead of many runs."""

    end: datetime
    step: timedelta
    runs: int
    days: int = 4

    def __post_init__(self) -> None:
        # Frames of one row per run are broadcast.
        if not 0 < self.runs <= MOST_RUNS:
            raise ValueError(f"a grid has from 1 to {MOST_RUNS} runs")

    @property
    def start(self) -> datetime:
        return self.end - self.step * (self.runs - 1)
