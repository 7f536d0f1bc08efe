import random

import pytest
from pyspark.sql import functions as F

# Names that operators use inside; a table may have columns of these names.
CLASHES = "id key set n a b u v size slot block bucket words line place group node component score spans row chunk digest label y doc rows copies copy tie __row_a __row_b __id __size __copies __copy __quality __words __row __h words".split()


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text, source) rows, with columns of clashing names."""

    def make(rows, clashes=True):
        rows = [(*r, *[None] * (3 - len(r))) for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        return df.withColumns({c: F.lit("x") for c in CLASHES}) if clashes else df

    return make


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau phi chi psi omega".split()


def prose(rng: random.Random, n: int, words=WORDS) -> str:
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


ODD = [(None, "a b c d e f"), (900, None), (901, ""), (902, " \n\t "), (903, "Ünï ☃ 漢字 x y"), (904, "one two"), (904, "one two"), (905, "w" * 9000)]
