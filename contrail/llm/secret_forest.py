"""Secret scan: pattern candidates, then a random forest removes false alarms.

Everything runs as DataFrame and SQL functions.  Candidates of a text come
from one regular expression (assignments to a credential word, private keys,
web tokens, long runs of key characters).  Values have no upper length: a
quoted one ends at its closing quote, an unquoted one at white space (sentence
signs at its end are left out), a private key at its END line.  The forest sees the value's length, character
classes and their transitions, its dictionary coverage, the
document's path and the neighbouring words; it is trained with Spark ML and
then written out as one SQL expression, so scoring needs neither a join nor
a shuffle and stays with the row.

The labelled findings come from the corpus: values of a documented key format
or assigned to a credential word with letters and digits are secrets;
placeholders, bare numbers (of cards or phones, say) and words without digits
are not; the others carry no label.  At most ``SAMPLE`` distinct values (smallest hash) are used.

Defined cases: a quote that nothing closes counts as none, so the value ends at
white space; a private key without an END line is its header and the key lines
that follow; a private key with key text is a secret whatever the forest says;
a null or empty text has no findings and stays as it is; a
null path counts as empty; without labels of both classes the weak label
itself decides (no label: not a secret); rows are independent, repeated rows
repeat their findings; an empty table gives no rows; ``redact`` keeps all
columns.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.sampling import bounded
from contrail.plans.tables import materialize

SAMPLE = 5000
TREES, DEPTH, SEED = 20, 6, 7
MARK = "[SECRET]"
CONTEXT = 60

#: Credential words, key formats, placeholders, common word parts.
_WORD = r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key|private[_-]?key|credential)s?"
_LEAD = rf"(?i:{_WORD})[\"']?\s{{0,2}}[:=]{{1,2}}+\s{{0,2}}+[\"']?+"
_BEGIN = r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"
#: A key from BEGIN to END; without an END, the header and key lines after it.
_GAP = r"(?:\s|\\[nr])"
_PEM = (rf"{_BEGIN}(?:(?:[^\-]++|-(?!----))*+-----END [A-Z ]{{0,30}}PRIVATE KEY-----"
        rf"|(?:{_GAP}++[A-Z][A-Za-z\-]{{1,30}}: [^\r\n]*+)*+(?:{_GAP}++[A-Za-z0-9+/]{{32,}}+={{0,2}}+)*+"
        rf"(?:(?<=[A-Za-z0-9+/=]{{32}})(?:\r?\n|\\n)[ \t]*+[A-Za-z0-9+/]++={{0,2}}+(?=\s|\\|$))?+)")
#: A quoted value goes to the quote that closes it, a bare one to white space (less sentence signs); JSON numbers and constants are none.
_QUOTED = "|".join(rf"(?<={q})(?=(?:[^{q}\\]|\\[\s\S]){{6}})(?:[^{q}\\]++|\\[\s\S])*+(?={q}(?![A-Za-z0-9]))" for q in "\"'")
_BARE = r"(?!(?:-?[0-9.]++|true|false|null)(?:,[\"']|[}\]]))[^\s\"'<>,;]\S{4,}[^\s\"'<>,;.!?)]"
PATTERN = (rf"{_LEAD}(?:{_PEM}|{_QUOTED}|{_BARE})"
           rf"|{_PEM}"
           r"|eyJ[A-Za-z0-9_\-]{15,}+(?:\.[A-Za-z0-9_\-]++){1,4}+"
           r"|[A-Za-z0-9+/_\-]{16,}={0,2}")
#: A private key with key text in it: a secret whatever the forest says.
KEY = rf"^{_BEGIN}[\s\S]*?[A-Za-z0-9+/]{{32}}"
FORMATS = (r"^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{30,}$|^sk[-_][A-Za-z0-9_\-]{20,}$"
           r"|^xox[abprs]-[0-9A-Za-z\-]{10,}$|^AIza[0-9A-Za-z_\-]{35}$|^eyJ[A-Za-z0-9_\-]{15,}"
           r"|^-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----")
PLACEHOLDERS = r"(?i)example|changeme|change_me|your[_-]|x{4,}|dummy|sample|placeholder|\*{3,}|\$\{|1234567"
PARTS = ("the|and|ing|tion|ent|that|for|ment|ness|able|ally|with|this|from|have|ould|ight|ough|ever|ther|ion|ers|est"
         "|ate|ous|ive|ful|der|die|und|sch|ein|ich|ung|keit|heit|lich|ver|ber|gen|ten|que|los|las|con|ado|aci"
         "|mente|para|por|les|des|eur|eux|oir|ais|ait|our|ant|onn|ell|in|er|on|an|re|en|es|st|at|nd|ed|or|is|it|ou")


def _sql(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _share(pattern: str) -> str:
    return f"length(regexp_replace(s.value, {_sql('[^' + pattern + ']')}, '')) / greatest(length(s.value), 1)"


#: Feature name -> SQL over a candidate ``s`` (value, lead, before, after, path).
FEATURES = {
    "length": "length(s.value)",
    "digits": _share("0-9"),
    "upper": _share("A-Z"),
    "lower": _share("a-z"),
    "signs": _share("+/_=."),
    "transitions": "(length(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(s.value, "
                   "'[0-9]+', '\\u0001'), '[A-Z]+', '\\u0002'), '[a-z]+', '\\u0003'), '[^\\u0001-\\u0003]+', "
                   "'\\u0004'), '[^\\u0001-\\u0004]', '')) - 1) / greatest(length(s.value), 1)",
    "distinct": "size(array_distinct(split(s.value, ''))) / greatest(length(s.value), 1)",
    "hex": f"if(s.value rlike {_sql('^[0-9a-fA-F]+$')}, 1, 0)",
    "coverage": f"1 - length(regexp_replace(lower(s.value), {_sql(PARTS)}, '')) / greatest(length(s.value), 1)",
    "letter_run": f"aggregate(transform(split(s.value, {_sql('[^A-Za-z]+')}), x -> length(x)), 0, "
                  "(a, b) -> greatest(a, b))",
    "assigned": "if(s.lead <> '', 1, 0)",
    "quoted": f"if(s.lead rlike {_sql('[' + chr(34) + chr(39) + ']$')}, 1, 0)",
    "word_before": f"if(s.before rlike {_sql('(?i)' + _WORD + r'[^A-Za-z0-9]{0,8}$')}, 1, 0)",
    "plain_before": f"if(s.before rlike {_sql(r'[a-z]{2,}[.,]?[ ]$')}, 1, 0)",
    "plain_after": f"if(s.after rlike {_sql(r'^[' + chr(34) + chr(39) + r']?[.,]?\s[A-Za-z][a-z]+')}, 1, 0)",
    "path_depth": "size(split(s.path, '/')) - 1",
    "path_test": f"if(s.path rlike {_sql('(?i)test|example|sample|mock|doc')}, 1, 0)",
}
NAMES = tuple(FEATURES)


def _candidates(text: str = "text", path: str = "''") -> str:
    """SQL array of the candidates of a text, features included."""
    p = _sql(PATTERN)
    found, rest = f"regexp_extract_all({text}, {p}, 0)", f"split({text}, {p}, -1)"
    total = "aggregate(transform(slice({0}, 1, {1}), x -> length(x)), 0, (a, b) -> a + b)"
    parts = (f"transform(array(named_struct('c', {found}, 'r', {rest})), d -> transform(d.c, (c, i) -> named_struct("
             f"'start', {total.format('d.r', 'i + 1')} + {total.format('d.c', 'i')}, 'c', c, "
             f"'lead', regexp_extract(c, {_sql('^' + _LEAD)}, 0), "
             f"'before', right(d.r[i], {CONTEXT}), 'after', left(d.r[i + 1], {CONTEXT}))))[0]")
    whole = (f"transform({parts}, s -> named_struct('start', s.start + length(s.lead), "
             f"'value', substring(s.c, length(s.lead) + 1), 'lead', s.lead, "
             f"'before', s.before, 'after', s.after, 'path', coalesce({path}, '')))")
    numbers = ", ".join(f"cast({v} as double)" for v in FEATURES.values())
    return f"transform({whole}, s -> named_struct('start', s.start, 'value', s.value, 'f', array({numbers}), 'label', {WEAK}))"


#: The weak label of a candidate ``s``: 1, 0 or null.
WEAK = (f"case when s.value rlike {_sql(KEY)} then 1 when s.value rlike {_sql(PLACEHOLDERS)} then 0 "
        f"when s.value rlike {_sql(FORMATS)} then 1 "
        f"when s.value rlike {_sql('^[0-9/_+-]+$')} then 0 "
        f"when s.value rlike {_sql('^[A-Za-z_-]+$')} and not s.value rlike {_sql('[a-z][A-Z].*[a-z][A-Z]')} then 0 "
        f"when s.lead <> '' and length(s.value) >= 8 and s.value rlike {_sql('[0-9]')} "
        f"and s.value rlike {_sql('[A-Za-z]')} then 1 end")


class Forest:
    """Scores as SQL over the features ``s.f``; ``trees`` holds nested
    (feature, threshold, left, right) tuples and leaf shares."""

    def __init__(self, trees: list):
        self.trees = trees

    @property
    def sql(self) -> str:
        if not self.trees:
            return "cast(coalesce(s.label, 0) as double)"
        return "(" + " + ".join(map(_tree_sql, self.trees)) + f") / {len(self.trees)}"


def _tree_sql(node) -> str:
    if not isinstance(node, tuple):
        return f"{float(node)!r}D"
    feature, threshold, left, right = node
    return f"if(s.f[{feature}] <= {float(threshold)!r}D, {_tree_sql(left)}, {_tree_sql(right)})"


def _read_tree(node):
    if node.subtreeDepth() == 0:
        none, some = list(node.impurityStats().stats())[:2]
        return some / (none + some) if none + some else 0.0
    cut = node.split()
    return cut.featureIndex(), cut.threshold(), _read_tree(node.leftChild()), _read_tree(node.rightChild())


def candidates(docs: DataFrame, path: str | None = "source") -> DataFrame:
    """One row a candidate: doc_id, start, value, f (features), label."""
    own = docs.select("doc_id", "text", (F.col(path) if path else F.lit("")).cast("string").alias("path"))
    rows = own.where(F.col("text").rlike(PATTERN))
    return rows.select("doc_id", F.explode(F.expr(_candidates("text", "path"))).alias("s")).select("doc_id", "s.*")


def fit(spark: SparkSession, docs: DataFrame, path: str | None = "source", sample: int = SAMPLE) -> Forest:
    values = candidates(docs, path).where("label IS NOT NULL").groupBy("value").agg(
        F.min_by("f", F.struct("doc_id", "start")).alias("f"), F.min("label").alias("label"))
    # written first: the texts are searched once
    rows = materialize(spark, bounded(materialize(spark, values, "values"), ["value"], sample), "findings")
    if rows.agg(F.count_distinct("label").alias("n")).first().n < 2:
        return Forest([])
    ready = rows.coalesce(1).sortWithinPartitions("value").select(
        array_to_vector("f").alias("features"), F.col("label").cast("double").alias("label"))
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=2, seed=SEED).fit(ready)
    return Forest([_read_tree(t._java_obj.rootNode()) for t in model.trees])


def findings(forest: Forest, text: str = "text", path: str = "source", least: float = 0.5) -> Column:
    """Array (start, length, score, secret) of a text's candidates, by place."""
    p = _sql(PATTERN)
    scored = (f"transform({_candidates(text, path)}, s -> named_struct('start', s.start, 'length', length(s.value), "
              f"'score', if(s.value rlike {_sql(KEY)}, 1D, {forest.sql})))")
    out = f"transform({scored}, s -> named_struct('start', s.start, 'length', s.length, 'score', s.score, 'secret', s.score >= {least}))"
    empty = "cast(array() as array<struct<start:int,length:int,score:double,secret:boolean>>)"
    return F.expr(f"if(coalesce({text} rlike {p}, false), {out}, {empty})")


def scan(docs: DataFrame, forest: Forest, path: str | None = "source") -> DataFrame:
    """doc_id, n_candidates, n_secrets, findings of every row of ``docs``."""
    own = docs.select("doc_id", "text", (F.col(path) if path else F.lit("")).cast("string").alias("path"))
    found = own.select("doc_id", findings(forest, path="path").alias("findings"))
    secrets = F.filter("findings", lambda f: f.secret)
    return found.select("doc_id", F.size("findings").alias("n_candidates"), F.size(secrets).alias("n_secrets"), "findings")


def redact(docs: DataFrame, forest: Forest, path: str | None = "source") -> DataFrame:
    """``docs`` with each secret replaced by ``MARK``; n_chars follows."""
    kept = docs.select(F.struct("*").alias("row"), F.col("text"), (F.col(path) if path else F.lit("")).cast("string").alias("path"))
    found = kept.select("row", findings(forest, path="path").alias("findings"))
    found = found.select("row", F.filter("findings", lambda f: f.secret).alias("secrets"))
    redacted = F.expr(
        "aggregate(secrets, named_struct('at', 0, 'done', ''), (a, f) -> named_struct('at', f.start + f.length, "
        f"'done', concat(a.done, substring(row.text, a.at + 1, f.start - a.at), {_sql(MARK)})), "
        "a -> concat(a.done, substring(row.text, a.at + 1)))")
    some = F.size("secrets") > 0
    made = found.select("row", some.alias("some"), F.when(some, redacted).otherwise(F.col("row.text")).alias("text"))
    new = {"text": F.col("text"), "n_chars": F.when(F.col("some"), F.length("text").cast("long")).otherwise(F.col("row.n_chars"))
           if "n_chars" in docs.columns else None}
    return made.select(*[new[c].alias(c) if new.get(c) is not None else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
