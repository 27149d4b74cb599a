"""Personal data: base patterns with checks, and further spans from high-recall generators that boosted trees
score by format and context; DataFrame functions only.

No table says where personal data stands. The trees learn from made-up data (MADE) that is put between words
of the given texts, where the generators find it or something like it: real spans and look-alikes are known."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import distinct_sample, read_table, stash

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Possessive, and started at the front of a run only, they find the same leftmost
#: matches in linear time and without deep recursion; \G lets a match start where the last one ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a search to be worth while.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
#: High-recall generators, by kind; they run where base spans are masked. Runs are possessive and start at the
#: front of a run only, so no length has to be bounded to keep them linear.
AT, DOT = r"(?:\x20?@\x20?|\x20?[(\[{](?i:at|@)[)\]}]\x20?|\x20(?i:at)\x20)", r"(?:\x20?\.\x20{0,2}(?=\w)|\x20?[(\[{](?i:dot|\.)[)\]}]\x20?|\x20(?i:dot)\x20)"
LOCAL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++"
GENERATORS = (
    ("email", LOCAL + AT + r"[A-Za-z0-9-]++(?:" + DOT + r"[A-Za-z0-9-]++)++", r"(?i)@|\bat\b"),
    ("ip", r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}+:){7}[0-9A-Fa-f]{1,4}+(?![0-9A-Za-z:])|(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}+:){1,6}:(?:[0-9A-Fa-f]{1,4}+:){0,5}[0-9A-Fa-f]{1,4}+(?![0-9A-Za-z:])", r"[0-9A-Fa-f]:"),
    ("ip", r"(?<![0-9])[0-9]{1,3}+(?:(?:\x20?[.,]\x20?|[(\[{](?i:dot|\.)[)\]}])[0-9]{1,3}+){3}(?![0-9])", r"[0-9]\x20?[.,(\[{]"),
    ("card", r"(?<![0-9])[0-9]++(?:[\x20._/-]{1,3}+[0-9]++){2,7}+|(?<![0-9])[0-9]{13,19}+(?![0-9])", r"[0-9]{4}"),
    ("phone", r"(?<![0-9.,])(?:\+|00)?\(?[0-9]{1,6}+\)?(?:[\x20./-]{1,3}+(?:\(0\)\x20?)?\(?[0-9]{2,9}+\)?){1,6}+", r"[0-9][\x20./)-]"),
    ("phone", r"(?<![0-9.,])0[0-9]{8,13}+(?![0-9])", r"0[0-9]{8}"),
)
MASK = "\u0001"
#: Texts that are looked at for training, and made-up spans to learn from.
MAX_TRAIN_DOCS, MAX_MADE = 4_000, 8_000
#: Characters of a text, at a place drawn for each made-up span, among whose words the span is put.
AROUND = 4_000
TREES, DEPTH, SEED = 20, 4, 7
#: Precision on held-back candidates that a kind's threshold must reach.
PRECISION = 0.95
#: Prefix sums run in blocks of so many matches.
BLOCK = 64

#: Made-up data to learn from. # is a digit, % one from 1 to 9, ^ a hexadecimal digit, ~ a letter, + two to nine
#: letters, & a number from 0 to 255, * the digit that completes a Luhn number. The first of each is its kind, none for look-alikes.
MADE = (
    ("email", "~+ at ~+ dot com"), ("email", "~+.~+ [at] ~+ [dot] org"), ("email", "~+(at)~+.de"), ("email", "~+@ ~+.com"), ("email", "~+ @ ~+.net"), ("email", "~+## AT ~+ DOT co DOT uk"),
    ("email", "~+{at}~+{dot}fr"), ("email", "~+.~+[@]~+.com"), ("email", "~+_~~ at ~+-~~~.org"), ("email", "~+ @~+ .com"), ("email", "~+## @ ~+ .  org"), ("email", "~+.~+ at ~+ dot ~~"),
    ("ip", "&,&,&,&"), ("ip", "& . & . & . &"), ("ip", "&[.]&[.]&[.]&"), ("ip", "&(dot)&(dot)&(dot)&"), ("ip", "& , & , & , &"),
    ("ip", "^^^^:^^^^:^^^^:^^^^:^^^^:^^^^:^^^^:^^^^"), ("ip", "^^^^:^^^:^:^^^^:^^^:^:^^^^:^^"), ("ip", "fe80::^^^:^^^^:^^^^"), ("ip", "2001:db8::^^^^:^"), ("ip", "2001:db8:^^^^::^"),
    ("card", "####.####.####.###*"), ("card", "####  ####  ####  ###*"), ("card", "####_####_####_###*"), ("card", "#### - #### - #### - ###*"), ("card", "####/####/####/###*"), ("card", "####.######.####*"), ("card", "#### . #### . #### . ###*"),
    ("phone", "00%# %# #######"), ("phone", "0%### ######"), ("phone", "(0%#) ###-####"), ("phone", "%##-###-####"), ("phone", "(%##) ###-####"), ("phone", "%##.###.####"), ("phone", "0%#/#######"),
    ("phone", "0%.##.##.##.##"), ("phone", "0% ## ## ## ##"), ("phone", "00%#-%#-#######"), ("phone", "0% #### ####"), ("phone", "0%##########"), ("phone", "00%# (0)%## ######"), ("phone", "0%#### ### ###"), ("phone", "%## %## ####"), ("phone", "0%# ## ## ###"),
    (None, "20##-0%-1#"), (None, "20##-0%-1# 1#"), (None, "20##-0%-1# 1#:2#:3#"), (None, "19## - 20##"), (None, "1#:2#:3#"), (None, "## ## ## ## ##"), (None, "%# %# %# %# %# %#"), (None, "%,###,###"),
    (None, "%##,###,###,###"), (None, "%##.###.###,##"), (None, "978-%-##-######-#"), (None, "####-####"), (None, "v%.#.##.#"), (None, "%.#.#"), (None, "^^^^^^^^-^^^^-^^^^-^^^^-^^^^^^^^^^^^"), (None, "20##.0%.1#"),
    (None, "~~~~ at the ~~~~ dot"), (None, "~~~ at ~~~~~~.The"), (None, "~~~~ at ~~~ dot ~~~~~~~~"), (None, "~~~~~ at ~~~~~~. ~~~~ dot ~~~"), (None, "## x ## x ##"), (None, "%#, %#, %#, %#, %#"), (None, "&,&,&,&,&,&"),
    (None, "%, %, %, %"), (None, "%.%.%.%.%"), (None, "####.####.####.####"), (None, "%################"), (None, "%###-%###-%###"), (None, "1#.0%.20##"), (None, "1#/0%/20## 1#:3#"), (None, "pp. %##-%##"), (None, "%## %### %##"),
    (None, "%##-##-%%"), (None, "%#/%#/%#"), (None, "^^:^^:^^:^^:^^:^^"), (None, "%##### %#####"), (None, "20## 20## 20##"), (None, "%##.## %##.## %##.##"), (None, "(%) %## (%) %##"), (None, "%:1# %:2# %:3#"), (None, "0%/1#/20##"), (None, "1#.1#.20##, 2#:1#"), (None, "2#.0%.19## 0%:2#"), (None, "&, &, &, &, &, &, &"), (None, "& , & , & , & , & , &"), (None, "~+ at ~+ dot"),
    (None, "~+ at ~+.But"), (None, "~+ at ~+. In ~+ . so"),
)
#: Words that stand before half of the made-up data, by kind; none for look-alikes.
CUES = {
    "email": ("write to ", "contact: ", "e-mail ", "mail me at "), "ip": ("from host ", "server at ", "ip ", "address "), "card": ("card ", "pay with ", "visa: ", "credit card no "),
    "phone": ("call ", "phone: ", "tel. ", "fax ", "mobile "), None: ("order ", "version ", "on ", "from ", "id ", "page ", "isbn ", "key = ", "total "),
}

CONTEXTS = (
    ("says_mail", r"(?i)e-?mail|contact|write|kontakt|correo|courriel"),
    ("says_phone", r"(?i)phone|tel|call|fax|mobile|mobil|telef|appel"),
    ("says_card", r"(?i)card|visa|credit|pay|karte|tarjeta|carte"),
    ("says_ip", r"(?i)\bip\b|host|server|addr|from"),
    ("says_secret", r"(?i)token|key|secret|passw|hash|sha|uuid|order|version|\bid\b|isbn"),
)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total, at):
        d = F.substring(number, F.length(number) - at, F.lit(1)).cast("int")
        return total + F.when(at % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def passes(kind: str, value: Column) -> Column:
    n = F.length(digits(value))
    if kind == "ip":
        return value.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return F.when(n.between(13, 19), luhn(digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def add_spans(df: DataFrame, text: str, pattern: str, needs: str, out: str) -> DataFrame:
    """Add `out`: (start, end, value, before, after) for every match in `text`, in code points. Null where
    there is none. Starts are sums of the lengths of pieces and matches, taken in blocks."""
    hits, gaps, steps, sums = f"{out}_hits", f"{out}_gaps", f"{out}_steps", f"{out}_sums"
    found = F.when(F.col(text).rlike(needs), F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    df = df.withColumn(hits, F.filter(found, lambda h: F.length(h) > 0))
    some = F.size(hits) > 0
    df = df.withColumn(gaps, F.when(some, F.split(F.col(text), pattern, -1)))
    df = df.withColumn(steps, F.transform(gaps, lambda g, i: F.length(g) + F.when(i > 0, F.length(F.get(F.col(hits), i - 1))).otherwise(0)))

    def total(values, first, n):
        return F.aggregate(F.slice(values, first + 1, n), F.lit(0), lambda a, x: a + x)

    blocks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int"))
    df = df.withColumn(sums, F.when(some, F.transform(blocks, lambda b: total(F.col(steps), b * BLOCK, F.lit(BLOCK)))))

    def span(value, i):
        block = F.floor(i / BLOCK).cast("int")
        start = total(F.col(sums), F.lit(0), block) + total(F.col(steps), block * BLOCK, i % BLOCK + 1)
        return F.struct(
            start.cast("long").alias("start"), (start + F.length(value)).cast("long").alias("end"), value.alias("value"),
            F.right(F.get(F.col(gaps), i), F.lit(24)).alias("before"), F.left(F.get(F.col(gaps), i + 1), F.lit(4)).alias("after"),
        )

    return df.withColumn(out, F.when(some, F.transform(hits, span))).drop(steps, sums)


def masked(text: Column, spans: str, kind: str) -> Column:
    """The text with the valid matches of a kind replaced by MASK, character for character."""

    def piece(gap, i):
        hit = F.get(F.col(f"{spans}_hits"), i)
        return F.concat(gap, F.coalesce(F.when(passes(kind, hit), F.repeat(F.lit(MASK), F.length(hit))).otherwise(hit), F.lit("")))

    return F.when(F.col(spans).isNotNull(), F.array_join(F.transform(F.col(f"{spans}_gaps"), piece), "")).otherwise(text)


def features(kind: Column, c: Column) -> dict[str, Column]:
    """Format and context of a candidate, as doubles."""
    value, n = c["value"], F.length(digits(c["value"]))
    last, first = F.right(c["before"], F.lit(1)), F.left(c["after"], F.lit(1))
    groups = F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0))
    lengths = F.transform(groups, lambda g: F.length(g))
    out = {f"is_{k}": kind == k for k in KINDS}
    out |= {
        "length": F.length(value),
        "n_digits": n,
        "n_letters": F.length(F.regexp_replace(value, "[^A-Za-z]", "")),
        "n_dots": F.length(F.regexp_replace(value, r"[^.]", "")),
        "n_commas": F.length(F.regexp_replace(value, "[^,]", "")),
        "n_breaks": F.length(F.regexp_replace(value, r"[^\x20()./_-]", "")),
        "n_colons": F.length(F.regexp_replace(value, "[^:]", "")),
        "has_at": value.contains("@"),
        "spelled_at": value.rlike(r"(?i)[(\[{](?:at|@)[)\]}]"),
        "spelled_dot": value.rlike(r"(?i)[(\[{ ](?:dot|\.)[)\]} ]"),
        "known_end": value.rlike(r"(?i)[\])}. ](?:com|org|net|edu|gov|info|io|eu|[a-z]{2})$"),
        "n_words": F.size(F.split(value, r"\x20")),
        "begins_plus": value.rlike(r"^(?:\+|00)"),
        "begins_zero": value.rlike(r"^\(?0"),
        "has_bracket": value.contains("("),
        "year": value.rlike(r"(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])"),
        "date": value.rlike(r"^(?:19|20)[0-9]{2}[-./ ](?:0?[1-9]|1[0-2])[-./ ][0-3]?[0-9](?![0-9])|(?<![0-9])[0-3]?[0-9][./-][01]?[0-9][./-](?:19|20)[0-9]{2}"),
        "luhn": F.when(n.between(13, 19), luhn(digits(value))).otherwise(F.lit(False)),
        "small_parts": (F.size(groups) > 0) & F.forall(groups, lambda p: (F.length(p) <= 3) & (F.coalesce(F.try_to_number(p, F.lit("999")), F.lit(999)) <= 255)),
        "n_groups": F.size(groups),
        "first_group": F.coalesce(F.get(lengths, F.lit(0)), F.lit(0)),
        "last_group": F.coalesce(F.get(lengths, F.size(lengths) - 1), F.lit(0)),
        "longest_group": F.coalesce(F.array_max(lengths), F.lit(0)),
        "shortest_group": F.coalesce(F.array_min(lengths), F.lit(0)),
        "glued_before": last.rlike(r"^[\p{L}0-9_=.\"'/-]$"),
        "glued_after": first.rlike(r"^[\p{L}0-9_=\"'/:-]$"),
        "comes_on": c["before"].rlike(r"[0-9]\x20?[.,:/-]?\x20?$"),
        "goes_on": c["after"].rlike(r"^\x20?[.,:/-]?\x20?[0-9]"),
    }
    out |= {name: c["before"].rlike(pattern) for name, pattern in CONTEXTS}
    return {k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in out.items()}


FEATURES = [
    *(f"is_{k}" for k in KINDS), "length", "n_digits", "n_letters", "n_dots", "n_commas", "n_breaks", "n_colons", "has_at", "spelled_at", "spelled_dot", "known_end", "n_words",
    "begins_plus", "begins_zero", "has_bracket", "year", "date", "luhn", "small_parts", "n_groups", "first_group", "last_group", "longest_group", "shortest_group",
    "glued_before", "glued_after", "comes_on", "goes_on", *(name for name, _ in CONTEXTS),
]


def checked(spans: str, kind: str) -> Column:
    return F.transform(F.col(spans), lambda s: s.withField("ok", passes(kind, s["value"])))


def add_base(docs: DataFrame, text: str) -> DataFrame:
    """Add __email, __ip, __card, __phone (all matches, with ok for those that pass) and __masked."""
    mask = F.col(text)
    for kind in KINDS:
        docs = add_spans(docs, text, BASE[kind], NEEDS[kind], f"__{kind}")
    for kind in KINDS:
        docs = docs.withColumn(f"__{kind}", checked(f"__{kind}", kind))
    docs = docs.withColumn("__masked", mask)
    for k, kind in enumerate(KINDS):
        # matches of later kinds are sought again, as earlier kinds may have taken a part of them
        if k:
            docs = add_spans(docs, "__masked", BASE[kind], NEEDS[kind], "__again")
        spans = f"__{kind}" if k == 0 else "__again"
        docs = docs.withColumn("__masked", masked(F.col("__masked"), spans, kind))
        docs = docs.drop("__again", "__again_hits", "__again_gaps", f"__{kind}_hits", f"__{kind}_gaps")
    return docs


def add_candidates(docs: DataFrame) -> DataFrame:
    """Add __found: (kind, start, end, value, before, after) from the generators on the masked text."""
    names = []
    for g, (kind, pattern, needs) in enumerate(GENERATORS):
        docs = add_spans(docs, "__masked", pattern, needs, f"__g{g}")
        names.append((kind, f"__g{g}"))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,value:string,before:string,after:string>>")

    def tagged(kind, name):
        return F.transform(F.col(name), lambda s: F.struct(F.lit(kind).alias("kind"), *[s[x].alias(x) for x in ("start", "end", "value", "before", "after")]))

    docs = docs.withColumn("__found", F.concat(*[F.coalesce(tagged(k, n), none) for k, n in names]))
    return docs.drop(*(x for _, n in names for x in (n, f"{n}_hits", f"{n}_gaps")))


@dataclass
class Redactor:
    """Trees (nested (feature, limit, left, right) or numbers), their weights, thresholds by kind."""

    trees: list = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)

    def score(self, x: Column) -> Column:
        """x: the array of FEATURES."""

        def branch(node):
            if isinstance(node, float):
                return F.lit(node)
            at, limit, left, right = node
            return F.when(F.get(x, F.lit(at)) <= F.lit(limit), branch(left)).otherwise(branch(right))

        margin = F.lit(0.0)
        for weight, tree in zip(self.weights, self.trees):
            margin = margin + F.lit(weight) * branch(tree)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-2 * margin))


def _nodes(node):
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _nodes(node.leftChild()), _nodes(node.rightChild()))


def made_texts(docs: DataFrame, text: str, made=MADE, seed: str = "made", bound: int = MAX_MADE) -> DataFrame:
    """(kind, pattern, value, __text, start): made-up spans between words of the texts of a sample of docs, as
    a written table."""
    sample, _ = distinct_sample(docs.select(F.col(text).alias("text")), "text", MAX_TRAIN_DOCS)
    sample = stash(sample)
    each = -(-bound // max(1, sample.count()))
    rows = sample.select("text", F.explode(F.sequence(F.lit(1), F.lit(each))).alias("n")).where(F.length("text") > 0)

    rows = rows.withColumn("seed", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "text", "n"), 1))
    kinds, patterns = F.array(*[F.lit(k) for k, _ in made]), F.array(*[F.lit(p) for _, p in made])
    rows = rows.withColumn("nth", (F.col("seed") % len(made)).cast("int")).select("*", F.get(kinds, F.col("nth")).alias("kind"), F.get(patterns, F.col("nth")).alias("pattern"))

    def letter(c, i):
        n = F.shiftrightunsigned(F.xxhash64("seed", i), 1)
        out = F.when(c == "#", (n % 10).cast("string")).when(c == "%", (n % 9 + 1).cast("string")).when(c == "&", (n % 256).cast("string"))
        run = F.transform(F.sequence(F.lit(1), (n % 8 + 2).cast("int")), lambda k: F.char(F.shiftrightunsigned(F.xxhash64(n, k), 1) % 26 + 97))
        return out.when(c == "^", F.lower(F.hex(n % 16))).when(c == "~", F.char(n % 26 + 97)).when(c == "+", F.array_join(run, "")).otherwise(c)

    value = F.array_join(F.transform(F.split("pattern", ""), letter), "")
    rows = rows.withColumn("value", value)
    fits = F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.replace(F.col("value"), F.lit("*"), d.cast("string"))), lambda v: luhn(digits(v)))
    rows = stash(rows.withColumn("value", F.when(F.col("pattern").contains("*"), F.get(fits, F.lit(0))).otherwise(F.col("value"))))
    # words around it come from a place anywhere in the text, without what could itself be personal data
    place = F.shiftrightunsigned(F.xxhash64("seed", F.lit("place")), 1) % F.greatest(F.length("text") - AROUND, F.lit(1))
    plain = F.regexp_replace(F.substring("text", (place + 1).cast("int"), F.lit(AROUND)), r"[^\p{L}\x20,;!?]+", " ")
    words = F.filter(F.split(plain, r"\x20+"), lambda w: F.length(w) > 0)
    rows = rows.withColumn("words", words)
    at = (F.shiftrightunsigned(F.xxhash64("seed", F.lit("at")), 1) % F.greatest(F.size("words"), F.lit(1))).cast("int")
    cue = F.lit("")
    for kind in (None, *KINDS):
        said = F.array(*[F.lit(c) for c in CUES[kind]])
        own = F.get(said, (F.shiftrightunsigned(F.xxhash64("seed", F.lit("cue")), 1) % len(CUES[kind])).cast("int"))
        cue = F.when(F.col("kind").eqNullSafe(F.lit(kind)), own).otherwise(cue)
    cue = F.when(F.xxhash64("seed", F.lit("cued")) % 2 == 0, cue).otherwise("")
    before = F.concat(F.array_join(F.slice("words", F.greatest(at - 3, F.lit(1)), F.lit(4)), " "), F.lit(" "), cue)
    after = F.concat(F.get(F.array(*[F.lit(x) for x in (" ", ", ", ". ", "\n", ") ")]), (F.col("seed") % 5).cast("int")), F.array_join(F.slice("words", at + 1, F.lit(4)), " "))
    rows = rows.withColumns({"__before": before, "__after": after})
    return stash(rows.select("kind", "pattern", "value", F.concat("__before", "value", "__after").alias("__text"), F.length("__before").cast("long").alias("start")))


def candidates(made: DataFrame) -> DataFrame:
    """(kind, label, FEATURES...) of all generated spans in made-up texts. One of the right kind that holds
    at least four fifths of a real span, and little more, is a hit (label 1)."""
    rows = add_candidates(add_base(made, "__text")).select(F.col("kind").alias("real"), F.col("value").alias("made"), F.col("start").alias("at"), "__found")
    rows = stash(rows).select("real", "made", "at", F.explode("__found").alias("c"))
    end = F.col("at") + F.length("made")
    common = F.least(F.col("c.end"), end) - F.greatest(F.col("c.start"), F.col("at"))
    hit = F.coalesce(F.col("real") == F.col("c.kind"), F.lit(False)) & (common * 5 >= F.length("made") * 4) & (common * 5 >= (F.col("c.end") - F.col("c.start")) * 4)
    x = features(F.col("c.kind"), F.col("c"))
    return rows.select(F.col("c.kind").alias("kind"), hit.cast("double").alias("label"), "made", *[x[f].alias(f) for f in FEATURES])


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Redactor:
    """Grow the trees on half of the made-up candidates and set each kind's threshold on the other half: the
    lowest score from which on PRECISION of the candidates are real. A kind that never reaches it adds
    nothing; an empty table or one without words trains nothing. key is not looked at."""
    rows = stash(candidates(made_texts(docs, text)))
    half = F.xxhash64(F.lit("half"), "made") % 2 == 0
    grown = rows.where(half).select("label", *FEATURES)
    if grown.select("label").distinct().count() < 2:
        return Redactor()
    grown = stash(grown.repartition(4, *FEATURES).sortWithinPartitions("label", *FEATURES))
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(grown).select("label", "features")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.3).fit(data)
    out = Redactor([_nodes(t._call_java("rootNode")) for t in model.trees], [float(w) for w in model.treeWeights])

    scored = rows.where(~half).select("kind", "label", F.floor(out.score(F.array(*FEATURES)) * 100).alias("score"))
    counts = scored.groupBy("kind", "score").agg(F.sum("label").alias("yes"), F.count("*").alias("all")).collect()
    for kind in KINDS:
        yes = all_ = 0.0
        for r in sorted((r for r in counts if r["kind"] == kind), key=lambda r: -r["score"]):
            yes, all_ = yes + r["yes"], all_ + r["all"]
            if r["score"] >= 30 and yes >= PRECISION * all_:
                out.thresholds[kind] = r["score"] / 100
    return out


def greedy(spans: Column) -> Column:
    """Of overlapping spans (start, less, end, nth; in order of start) those that stay: the best score first,
    each if it meets none that stays already. Spans are cut into clusters that don't meet each other, so a
    text with many spans is not compared in all pairs."""

    def settle(cluster):
        by_score = F.array_sort(F.transform(cluster, lambda s: F.struct(s["less"].alias("less"), s["start"].alias("start"), s["end"].alias("end"), s["nth"].alias("nth"))))
        none = F.filter(by_score, lambda s: F.lit(False))
        free = F.aggregate(by_score, none, lambda kept, s: F.when(F.exists(kept, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"])), kept).otherwise(F.concat(kept, F.array(s))))
        return F.when(F.size(cluster) > 1, free).otherwise(by_score)

    empty = F.filter(spans, lambda s: F.lit(False))
    out = F.transform(empty, lambda s: F.struct(s["less"].alias("less"), s["start"].alias("start"), s["end"].alias("end"), s["nth"].alias("nth")))
    start = F.struct(out.alias("out"), empty.alias("cluster"), F.lit(-1).cast("long").alias("reach"))

    def step(a, s):
        apart = F.struct(F.concat(a["out"], settle(a["cluster"])).alias("out"), F.array(s).alias("cluster"), s["end"].alias("reach"))
        joins = F.struct(a["out"].alias("out"), F.concat(a["cluster"], F.array(s)).alias("cluster"), F.greatest(a["reach"], s["end"]).alias("reach"))
        return F.when(s["start"] >= a["reach"], apart).otherwise(joins)

    return F.aggregate(spans, start, step, lambda a: F.concat(a["out"], settle(a["cluster"])))


def find_personal_data(docs: DataFrame, model: Redactor, keep: list, text: str = "text") -> DataFrame:
    """The columns of `keep` with n_email, n_ip, n_card, n_phone (base spans), base and spans (arrays of
    kind, start, end by kind, then start; spans holds the base spans and the added ones), for every row.

    Null and empty texts have none; equal texts are treated alike; of added spans that overlap the best
    score stays, then the earlier; an empty table gives no rows; columns that aren't in `keep` are ignored.
    """
    rows = docs.select(F.struct(*keep).alias("__keep"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    rows = add_candidates(add_base(rows, "__text"))
    span = "array<struct<nth:int,start:bigint,end:bigint>>"

    def base(k):
        ok = F.filter(F.col(f"__{KINDS[k]}"), lambda s: s["ok"])
        return F.coalesce(F.transform(ok, lambda s: F.struct(F.lit(k).alias("nth"), s["start"].alias("start"), s["end"].alias("end"))).cast(span), F.array().cast(span))

    for k in range(len(KINDS)):
        rows = rows.withColumn(f"__b{k}", base(k))
    rows = rows.withColumn("__base", F.concat(*[F.col(f"__b{k}") for k in range(len(KINDS))]))
    if model.trees and model.thresholds:
        def described(c):
            x = features(c["kind"], c)
            return F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), F.array(*[x[f] for f in FEATURES]).alias("x"))

        def judged(c):
            limit, number = F.lit(2.0), F.lit(0)
            for k, kind in enumerate(KINDS):
                limit = F.when(c["kind"] == kind, F.lit(model.thresholds.get(kind, 2.0))).otherwise(limit)
                number = F.when(c["kind"] == kind, F.lit(k)).otherwise(number)
            score = model.score(c["x"])
            return F.struct(c["start"].alias("start"), (-score).alias("less"), c["end"].alias("end"), number.alias("nth"), (score >= limit).alias("yes"))

        good = F.filter(F.transform(F.transform(F.col("__found"), described), judged), lambda c: c["yes"])
        rows = rows.withColumn("__good", F.when(F.size("__found") > 0, F.array_sort(good)))
        added = F.transform(greedy(F.col("__good")), lambda c: F.struct(c["nth"].alias("nth"), c["start"].alias("start"), c["end"].alias("end"))).cast(span)
        rows = rows.withColumn("__all", F.when(F.size("__good") > 0, F.array_sort(F.concat("__base", added))).otherwise(F.col("__base")))
    else:
        rows = rows.withColumn("__all", F.col("__base"))
    name = F.array(*[F.lit(k) for k in KINDS])

    def named(column):
        return F.transform(F.col(column), lambda s: F.struct(F.get(name, s["nth"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    counts = [F.size(f"__b{k}").cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return rows.select("__keep.*", *counts, named("__base").alias("base"), named("__all").alias("spans"))


def joined(spans: str) -> Column:
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_boosted_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_personal_data(docs, fit(docs), [F.col("doc_id")])
    counts = [f"n_{k}" for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


QUERIES = {"op7_boosted_personal_data": op7_boosted_personal_data}
ORACLES: dict[str, str] = {}
