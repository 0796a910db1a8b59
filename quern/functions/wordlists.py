"""Word and phrase lists: text files of the user, and the public English stop words."""

from __future__ import annotations

import functools
from pathlib import Path

#: org/apache/spark/ml/feature/stopwords/english.txt of Spark's mllib archive: not every installation has the archive beside pyspark
_ENGLISH = """
    a about above after again against all am an and any are aren't as at be because been before being below between both but by can can't cannot
    could couldn't did didn't do does doesn't doing don don't down during each few for from further had hadn't has hasn't have haven't having he
    he'd he'll he's her here here's hers herself him himself his how how's i i'd i'll i'm i've if in into is isn't it it's its itself just let's
    me more most mustn't my myself no nor not now of off on once only or other ought our ours ourselves out over own s same shan't she she'd
    she'll she's should shouldn't so some such t than that that's the their theirs them themselves then there there's these they they'd they'll
    they're they've this those through to too under until up very was wasn't we we'd we'll we're we've were weren't what what's when when's
    where where's which while who who's whom why why's will with won't would wouldn't you you'd you'll you're you've your yours yourself
    yourselves
"""


def load_wordlist(path: str | None, lower: bool = True) -> list[str]:
    """One entry a line; blank lines and comments (#) are skipped.  Without a path, none."""
    if not path:
        return []
    if not Path(path).exists():
        raise FileNotFoundError(path)
    found = (x.strip() for x in Path(path).read_text(encoding="utf-8").splitlines())
    return [x.lower() if lower else x for x in found if x and not x.startswith("#")]


@functools.cache
def english_stop_words() -> tuple[str, ...]:
    """The list that ships with Spark (neither a session nor its archive is needed)."""
    return tuple(_ENGLISH.split())
