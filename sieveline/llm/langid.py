"""Language of a text: first its family, then a duel of linear classifiers between the family's languages."""

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm.tables import text_of
from sieveline.staging import spread, stage

# At most so many rows of each language, and on each side of a classifier, fit the model.
FIT_ROWS = 1_000
BUCKETS, LONGEST_GRAM = 1 << 13, 3
# Texts are read in pieces of so many characters, all of them.
PIECE = 1 << 20
ROWS_AT_ONCE = 256
COST, SWEEPS, ENOUGH = 10.0, 60, 1e-3
# Score of a text by the least margin that its language won by.
SLOPE = 4.0
UNDETERMINED = "und"

# ISO 639 codes by family. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi".split(),
    "romance": "ca es fr gl it la oc pt ro".split(),
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk".split(),
    "celtic": "br cy ga gd".split(),
    "baltic": "lt lv".split(),
    "uralic": "et fi hu se".split(),
    "turkic": "az kk ky tr tt ug uz".split(),
    "indo-aryan": "bn gu hi mr ne pa sd si ur".split(),
    "iranian": "fa ku ps tg".split(),
    "dravidian": "kn ml ta te".split(),
    "semitic": "am ar he mt ti".split(),
    "malayo-polynesian": "fil id jv mg mi ms su tl".split(),
    "sinitic": "yue zh".split(),
    "bantu": "rw sn sw xh zu".split(),
}


@dataclass(frozen=True)
class Model:
    """Families as ((name, languages), ...), the classifiers' names, and one row of weights for each.

    A classifier is (family, None), that family against all others, or
    (language, language), the first against the second. The last weight is the bias.
    """

    families: tuple
    classifiers: tuple
    weights: np.ndarray


def held_out(doc_id):
    """One row in three, by crc32 of the id as text: never used to fit."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def letter_table():
    """True for each code point that is a letter."""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def profile(text, letters):
    """Square roots of the shares of a text's letter n-grams by bucket, a unit vector; None without a letter.

    Letters are lower-cased, each run of other characters is one gap, and so are the ends.
    """
    counts, tail = np.zeros(BUCKETS, np.int64), np.zeros(1, np.uint64)
    starts = range(0, len(text), PIECE)
    for start in starts:
        codes = np.frombuffer(text[start : start + PIECE].lower().encode("utf-32-le", "replace"), np.uint32)
        codes = np.where(letters[codes], codes, 0).astype(np.uint64)
        if start == starts[-1]:
            codes = np.r_[codes, np.uint64(0)]
        # Of the gaps that follow each other the first stays.
        follows = np.r_[tail[-1:], codes[:-1]] if len(codes) else codes
        codes = codes[(codes != 0) | (follows != 0)]
        joined = np.r_[tail, codes]
        grams, before = np.zeros(len(joined), np.uint64), len(tail)
        for n in range(1, LONGEST_GRAM + 1):
            reach = len(joined) - n + 1
            if reach <= 0:
                break
            grams = grams[:reach] * np.uint64(0x9E3779B97F4A7C15) + joined[n - 1 :] + np.uint64(n)
            # Those that end in the tail were counted with the piece before.
            new = grams[max(0, before - n + 1) :]
            if n == 1:
                new = new[joined[before:] != 0]
            mixed = (new ^ (new >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            counts += np.bincount((mixed >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1), minlength=BUCKETS)
        tail = joined[-LONGEST_GRAM + 1 :]
    total = counts.sum()
    return np.sqrt(counts / total).astype(np.float32) if total else None


def svm(x, y, cost=COST, sweeps=SWEEPS):
    """Weights and bias of a linear support vector machine with squared hinge loss, both sides weighing the same.

    Dual coordinate descent in a fixed order of shuffles. `y` is 1 or -1.
    """
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, max(1, (y > 0).sum()), max(1, (y < 0).sum()))
    slack = share * 2 / len(y) / (2 * cost)
    steep = np.einsum("ij,ij->i", x, x) + slack
    alpha, weights, order = np.zeros(len(x)), np.zeros(x.shape[1], np.float32), np.random.default_rng(0)
    for _ in range(sweeps):
        worst = 0.0
        for i in order.permutation(len(x)):
            slope = y[i] * float(weights @ x[i]) - 1 + alpha[i] * slack[i]
            if alpha[i] > 0 or slope < 0:
                worst = max(worst, abs(slope))
                new = max(alpha[i] - slope / steep[i], 0.0)
                weights += np.float32((new - alpha[i]) * y[i]) * x[i]
                alpha[i] = new
        if worst < ENOUGH:
            break
    return weights


def _sample(known, rows):
    """Up to `rows` profiles of each language, those of least hash of doc_id: (lang, draw, profile).

    The hashes alone are ranked first, and Spark limits each language before it
    shuffles them; only texts up to a language's last hash are read on.
    """
    known = known.withColumn("draw", F.xxhash64("doc_id"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    first = known.select("lang", "draw").withColumn("n", place).where(F.col("n") <= rows)
    # One row per language.
    last = stage(first.groupBy("lang").agg(F.max("draw").alias("_last")), "last")
    drawn = known.join(F.broadcast(last), "lang").where(F.col("draw") <= F.col("_last"))
    by = Window.partitionBy("lang").orderBy("draw", "text")
    drawn = drawn.withColumn("n", F.row_number().over(by)).where(F.col("n") <= rows).select("lang", "draw", "text")

    def run(batches):
        letters = letter_table()
        for batch in batches:
            found = [profile(text.as_py(), letters) for text in batch.column(2)]
            made = pa.array([None if one is None else one.tobytes() for one in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], ["lang", "draw", "profile"])

    made = drawn.mapInArrow(run, "lang string, draw long, profile binary").where("profile IS NOT NULL")
    return stage(made, "profiles")


def family_of(languages, families=None):
    """((family, languages), ...) of the given languages, in order."""
    by_code = {code: family for family, codes in (families or FAMILIES).items() for code in codes}
    groups = {}
    for language in sorted(languages):
        groups.setdefault(by_code.get(language, language), []).append(language)
    return tuple(sorted((family, tuple(members)) for family, members in groups.items()))


def fit(docs, rows=FIT_ROWS, families=None):
    """Model from at most `rows` of the rows of each language (doc_id, text, lang), the same for the same rows.

    Rows with a null lang or a text without letters teach nothing. The
    classifiers are trained side by side in Spark tasks, each on at most `rows`
    rows a side; only their weights reach the driver, 32 KB each: one for each
    family and one for each pair of languages of a family. Without any rows the model knows no language.
    """
    known = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"), docs["lang"].cast("string").alias("lang")
    )
    known = known.where("lang IS NOT NULL AND text <> ''")
    sample = _sample(known, rows)
    learned = {row.lang for row in sample.select("lang").distinct().toLocalIterator()}
    groups = family_of(learned, families)
    classifiers = [(family, None) for family, _ in groups] if len(groups) > 1 else []
    classifiers += [pair for _, members in groups for pair in itertools.combinations(members, 2)]
    if not classifiers:
        return Model(groups, (), np.zeros((0, BUCKETS + 1), np.float32))
    sides = []
    for number, (one, other) in enumerate(classifiers):
        if other is None:
            sides += [(number, lang, 1 if family == one else -1) for family, members in groups for lang in members]
        else:
            sides += [(number, one, 1), (number, other, -1)]
    spark = docs.sparkSession
    sides = F.broadcast(spark.createDataFrame(sides, "classifier int, lang string, side int"))
    by = Window.partitionBy("classifier", "side").orderBy("draw", "lang", "profile")
    taught = sample.join(sides, "lang").withColumn("n", F.row_number().over(by)).where(F.col("n") <= rows)

    def train(group):
        group = group.sort_by([("side", "ascending"), ("n", "ascending")])
        x = np.stack([np.frombuffer(one.as_buffer(), np.float32) for one in group["profile"]])
        weights = svm(x, group["side"].to_numpy().astype(np.float64))
        number = group["classifier"][0].as_py()
        return pa.table({"classifier": pa.array([number], pa.int32()), "weights": pa.array([weights.tobytes()], pa.binary())})

    taught = taught.select("classifier", "side", "n", "profile").repartition(len(classifiers), "classifier")
    trained = taught.groupBy("classifier").applyInArrow(train, "classifier int, weights binary")
    weights = np.zeros((len(classifiers), BUCKETS + 1), np.float32)
    for row in trained.toLocalIterator():
        weights[row.classifier] = np.frombuffer(bytes(row.weights), np.float32)
    return Model(groups, tuple(classifiers), weights)


def judge(model, profiles):
    """(language, score) per row of a matrix of profiles: family of the highest margin, then most duels won.

    Equal numbers of duels go by the sum of margins, then by name. The score is
    a logistic function of the least margin that the language, and its family, won by.
    """
    margins = profiles @ model.weights[:, :-1].T + model.weights[:, -1]
    place = {classifier: i for i, classifier in enumerate(model.classifiers)}
    least = np.full(len(profiles), np.inf)
    family = np.zeros(len(profiles), np.int64)
    if len(model.families) > 1:
        of_family = margins[:, [place[name, None] for name, _ in model.families]]
        family = of_family.argmax(axis=1)
        ordered = np.sort(of_family, axis=1)
        least = (ordered[:, -1] - ordered[:, -2]) / 2
    language = np.zeros(len(profiles), object)
    for number, (_, members) in enumerate(model.families):
        at = np.flatnonzero(family == number)
        duels = np.full((len(at), len(members), len(members)), np.inf)
        for i, j in itertools.combinations(range(len(members)), 2):
            duels[:, i, j] = margins[at, place[members[i], members[j]]]
            duels[:, j, i] = -duels[:, i, j]
        won = (duels > 0).sum(axis=2) + 1e-6 * np.tanh(np.where(np.isinf(duels), 0, duels).sum(axis=2))
        best = won.argmax(axis=1)
        language[at] = np.array(members, object)[best]
        least[at] = np.minimum(least[at], duels[np.arange(len(at)), best].min(axis=1))
    return language, 1 / (1 + np.exp(-SLOPE * np.clip(least, -9, 9)))


def with_language(docs, model, name="lang_pred", score="score"):
    """`docs` with the language of each whole text and its score, 0 to 1, in two last columns.

    Both are functions of the text alone. A null or empty text, one without a letter, and any text
    by a model that knows no language are `und` with score 0. A model of one
    language gives it to every text with a letter. Columns of `docs` with these names are replaced;
    an empty table gives no rows.
    """
    docs = docs.select(*(column for column in docs.columns if column not in (name, score)))

    def run(batches):
        letters = letter_table()
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            languages, scores = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
            for start in range(0, len(texts), ROWS_AT_ONCE):
                found = [profile(text.as_py(), letters) for text in texts.slice(start, ROWS_AT_ONCE)]
                at = [start + i for i, one in enumerate(found) if one is not None]
                if at and model.families:
                    languages[at], scores[at] = judge(model, np.stack([one for one in found if one is not None]))
            rest = [batch.column(i) for i in range(batch.num_columns - 1)]
            names = [*batch.schema.names[:-1], name, score]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(languages.tolist(), pa.string()), pa.array(scores)], names)

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.StringType()), T.StructField(score, T.DoubleType())])
    return spread(docs.select("*", text_of(docs).alias(name))).mapInArrow(run, schema)
