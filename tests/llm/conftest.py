import re

import pytest

from quantsilo.session import get_spark


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_spark("local[4]", shuffle_partitions=4, app_name="llm-tests",
                  extra={"spark.driver.memory": "4g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield s


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a long text, and columns with clashing names."""
    long = "lorem ipsum dolor sit amet " * 4000
    rows = [(1, "The cat sat on the mat and the dog lay by the door", "en"), (2, "The  cat sat on the mat and the dog lay by the door", "en"),
            (3, None, "en"), (4, "", None), (5, " \t\n", "de"), (6, "der Hund und die Katze sind im Haus", "de"),
            (6, "der Hund und die Katze sind im Haus", "de"), (None, "text without id", "en"), (8, long, "en"),
            (9, long, "en"), (10, "Released under the MIT License.", "en"), (11, "é", "fr"), (12, "123 456", "fr")]
    return spark.createDataFrame([(i, t, la, "s", 0, 0, "x", 0.5) for i, t, la in rows],
                                 "doc_id long, text string, lang string, source string, n int, node int, "
                                 "sha string, score double")


def _components_of(texts, words, num, den):
    sets = {}
    for i, t in texts.items():
        w = WORDS.findall(re.sub('[A-Z]', lambda c: c[0].lower(), t or ''))
        sets[i] = {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sets:
        for j in sets:
            if j < i and sets[i] and sets[j]:
                k = len(sets[i] & sets[j])
                if den * k >= num * (len(sets[i]) + len(sets[j]) - k):
                    a, b = sorted((top(i), top(j)))
                    up[b] = a
    return {i: (len(s), top(i)) for i, s in sets.items()}


@pytest.fixture(scope="session")
def components_of():
    """Sizes and components of texts by comparing all pairs."""
    return _components_of
