"""SQL-native text, vendor and price features.

Everything is a column expression or a join/aggregation, so each step can be
checked against SQL.  Per-row work (tokens, stop words, n-grams) is done with
higher-order functions on the row's own token array: no shuffle until terms
are counted.  The vocabulary is capped at `k` terms, so it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import COLS, Cols
from ..functions.text import tokens as _tokens
from . import grams
from .rank import dense_codes, hash_rank


# Spark ML's default English stop words (StopWordsRemover), in its order.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
    herself it its itself they them their theirs themselves what which who whom this that these those am is are
    was were be been being have has had having do does did doing a an the and but if or because as until while of
    at by for with about against between into through during before after above below to from up down in out on
    off over under again further then once here there when where why how all any both each few more most other
    some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
    we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
    they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
    mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
    would
    """.split()
)


#: Most words that `vocabulary` looks at on the driver.
TIES = 8192


def english_stop_words() -> tuple[str, ...]:
    """Spark ML's default English stop-word list."""
    return ENGLISH_STOP_WORDS


def clean_tokens(text, stop: tuple[str, ...] | None = None) -> Column:
    """Tokens with stop words removed, order and repeats kept."""
    stop = list(english_stop_words() if stop is None else stop)
    # an IN list of literals becomes a hash-set lookup
    return F.filter(_tokens(text), lambda x: ~x.isin(stop))


def ngrams(tok: Column, n: int = C.NGRAM_MAX) -> Column:
    """Unigrams followed by all 2..n-grams of a token array (space-joined).

    k-grams are the (k-1)-grams side by side with the tokens that follow them, so every array is evaluated once
    per row; a lambda that looked tokens up by place would evaluate `tok` again for each of them."""
    out = parts = tok
    for k in range(2, n + 1):
        left = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
        right = F.slice(tok, F.lit(k), F.greatest(F.size(tok) - (k - 1), F.lit(0)))
        parts = F.zip_with(left, right, lambda a, b: F.concat_ws(" ", a, b))
        out = F.concat(out, parts)
    return out


def term_array(df: DataFrame, cols: Cols = COLS, stop: tuple[str, ...] | None = None, n: int = C.NGRAM_MAX) -> DataFrame:
    """(id, _terms): every term occurrence of each row, in the row.

    The cleaned token array is its own projection so that the n-gram
    expression refers to it instead of re-tokenising the text."""
    tok = df.select(cols.id, clean_tokens(cols.text, stop).alias("_tok"))
    return tok.select(cols.id, ngrams(F.col("_tok"), n).alias("_terms"))


def terms(df: DataFrame, cols: Cols = COLS, stop: tuple[str, ...] | None = None, n: int = C.NGRAM_MAX) -> DataFrame:
    """(id, term) for every term occurrence of every row.

    Not the inner `explode`: from that the optimizer infers size(_terms) > 0 and moves it below the projections,
    where the whole text is tokenised once more for it."""
    every = term_array(df, cols, stop, n).select(cols.id, F.explode_outer("_terms").alias("term"))
    return every.where(F.col("term").isNotNull())


def _all_counts(df: DataFrame, cols: Cols, stop, n: int) -> DataFrame:
    """(term, freq, df) of every term: each row gives its terms, and its distinct terms marked."""
    once = F.transform(F.array_distinct("_terms"), lambda t: F.struct(t.alias("term"), F.lit(1).alias("d")))
    every = F.transform(F.col("_terms"), lambda t: F.struct(t.alias("term"), F.lit(0).alias("d")))
    marked = term_array(df, cols, stop, n).select(F.explode(F.concat(every, once)).alias("t")).select("t.term", "t.d")
    return marked.groupBy("term").agg(F.sum(1 - F.col("d")).alias("freq"), F.sum("d").alias("df"))


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.sum("freq").alias("freq"), F.sum("df").alias("df"))


def vocabulary(df: DataFrame, k: int = C.VOCAB_SIZE, cols: Cols = COLS, stop=None, n: int = C.NGRAM_MAX) -> DataFrame:
    """The `k` most frequent terms over the corpus (ties: smaller term first), with their document frequency.

    Single words first.  An n-gram occurs at most as often as each of its words, so only n-grams of words at least as
    frequent as the k-th word can be among the k first, and no others are counted: what is shuffled for them is
    bounded by k, not by the distinct n-grams.  At most `TIES` words reach the driver; if more words than that
    are as frequent as the k-th one, every term is counted."""
    tok = df.select(clean_tokens(cols.text, stop).alias("_tok"))
    order = F.desc("freq"), F.asc("term")
    single = _summed(tok.mapInArrow(grams.words(), grams.COUNTS)).orderBy(*order)
    if n == 1:
        return single.limit(k)
    bound = max(TIES, 2 * k)
    top = single.limit(bound).collect()
    least = top[k - 1]["freq"] if 0 < k <= len(top) else 0
    if len(top) == bound and top[-1]["freq"] >= least:
        return _all_counts(df, cols, stop, n).orderBy(*order).limit(k)
    frequent = [r for r in top if r["freq"] >= least]
    several = _summed(tok.mapInArrow(grams.longer([r["term"] for r in frequent], n), grams.COUNTS))
    return several.unionByName(df.sparkSession.createDataFrame(frequent, grams.COUNTS)).orderBy(*order).limit(k)


def top_terms(term_df: DataFrame, k: int = C.VOCAB_SIZE) -> DataFrame:
    """The `k` most frequent terms straight from the term stream: one
    map-side-combined aggregation and a top-k."""
    counts = term_df.groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
    return counts.orderBy(F.desc("freq"), F.asc("term")).limit(k)


def _per_id(df: DataFrame, terms: list[str], idf: list[float] | None, cols: Cols, stop) -> DataFrame:
    """(id, term, tf), and a normalised weight with `idf`, of the given terms.

    Rows are dealt out by id once, as text; all terms of an id are counted where they arrive, and only these
    counts become rows."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    own = df.select(cols.id, cols.text).repartition(cols.id).sortWithinPartitions(cols.id)
    tok = own.select(cols.id, clean_tokens(cols.text, stop).alias("_tok"))
    id_field = tok.schema[0]
    more = [] if idf is None else [("weight", pa.float64())]
    arrow = pa.schema([(cols.id, to_arrow_type(id_field.dataType)), ("term", pa.string()), ("tf", pa.int64()), *more])
    schema = f"`{cols.id}` {id_field.dataType.simpleString()}, term string, tf long" + (", weight double" if more else "")
    return tok.mapInArrow(grams.per_id(terms, idf, arrow), schema)


def term_freq(df: DataFrame, vocab: DataFrame, cols: Cols = COLS, stop=None) -> DataFrame:
    """(id, term, the other columns of `vocab`, tf) per row and vocabulary term; other terms are dropped."""
    known = vocab.collect()  # at most k rows
    keep = [c for c in vocab.columns if c != "term"]
    counts = _per_id(df, [r["term"] for r in known], None, cols, stop)
    if keep:
        counts = counts.join(F.broadcast(df.sparkSession.createDataFrame(known, vocab.schema)), "term")
    return counts.select(cols.id, "term", *keep, "tf")


def idf(vocab: DataFrame, docs: DataFrame) -> DataFrame:
    """Smoothed inverse document frequency ln((1+N)/(1+df)) + 1 per vocabulary term."""
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    return vocab.select(
        "term", "df", (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf")
    )


def fit_text(df: DataFrame, k: int = C.VOCAB_SIZE, cols: Cols = COLS, stop=None) -> DataFrame:
    """Fitted vocabulary with idf: (term, df, idf); at most k rows."""
    return idf(vocabulary(df, k, cols, stop), df)


def tfidf(df: DataFrame, vocab_idf: DataFrame, cols: Cols = COLS, stop=None) -> DataFrame:
    """tf·idf per (row, vocabulary term), L2-normalised per row; unknown terms are ignored."""
    known = vocab_idf.select("term", "idf").collect()  # at most k rows
    return _per_id(df, [r["term"] for r in known], [r["idf"] for r in known], cols, stop)


def vendor_index(train: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Training vendors in alphabetical order, 0-based."""
    r = dense_codes(train, cols.vendor, "_r")
    return r.select(cols.vendor, (F.col("_r") - 1).alias("vendor_index"))


def vendor_onehot(df: DataFrame, vendors: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Long form of the vendor one-hot: (id, vendor_index, 1.0); unseen vendor → no entry."""
    return df.join(vendors, cols.vendor, "inner").select(
        cols.id, "vendor_index", F.lit(1.0).alias("value")
    )


def price_eur(df: DataFrame, fx: DataFrame, cols: Cols = COLS, out: str = "price_eur") -> DataFrame:
    """Price in EUR; a currency without a rate converts at 1.0."""
    rates = F.broadcast(fx.select(F.col("currency").alias("_cur"), F.col("to_eur").alias("_rate")))  # literal rows
    return (
        df.join(rates, F.col(cols.currency) == F.col("_cur"), "left")
        .withColumn(out, F.col(cols.price) * F.coalesce(F.col("_rate"), F.lit(C.UNKNOWN_FX_RATE)))
        .drop("_cur", "_rate")
    )


def price_stats(train: DataFrame, col: str = "price_eur") -> DataFrame:
    """One row: mean and population deviation (0 deviation → scale 1)."""
    return train.agg(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std")).select(
        "mean", "std", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")).alias("scale")
    )


def price_z(df: DataFrame, stats: DataFrame, col: str = "price_eur", out: str = "price_z") -> DataFrame:
    """z-score with the training mean and deviation."""
    mean = stats.select("mean").scalar()
    scale = stats.select("scale").scalar()
    return df.withColumn(out, (F.col(col) - mean) / scale)


def split_strat(
    df: DataFrame, label: str, frac: float, seed: int = C.SEED, id_col: str = COLS.id, out: str = "is_test", digits: int = 3
) -> DataFrame:
    """Stratified split: per label, the first round(frac·n) rows by md5(seed‖id) are test.

    Exact sizes; a label with a third of the rows is spread over many tasks, see `hash_rank`."""
    key = F.md5(F.concat(F.lit(str(seed)), F.col(id_col).cast("string")))
    r = hash_rank(df, label, key, F.col(id_col), "_rn", "_gn", digits)
    return r.withColumn(out, F.col("_rn") <= F.round(F.lit(frac) * F.col("_gn"))).drop("_rn", "_gn")


def label_codes(train: DataFrame, label: str = COLS.label) -> DataFrame:
    """Labels in alphabetical order, 0-based index (encoder / decoder table)."""
    r = dense_codes(train, label, "_r")
    return r.select(label, (F.col("_r") - 1).cast("double").alias("label_index"))
