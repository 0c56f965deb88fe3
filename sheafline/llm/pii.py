"""Personal data: candidate spans, boosted trees that score them, calibrated thresholds that select.

All of it is DataFrame functions. Patterns propose spans with their places (the pieces that ``split``
leaves between a pattern's matches give the places in code points). Four patterns with checks are the
base, whose spans always stay. Two more for each kind are high-recall proposals that overlap each other
and much that is not personal: a small gradient boosting over the form of a span and the words before it
scores each, its trees unrolled into one CASE expression. Those over the threshold of their kind are
taken in the order of their scores, each unless it overlaps one taken before; no base span is overlapped.

A row's spans are walked by running folds over chunks of CHUNK spans, so a text with very many of them
costs little more than its length.

The trees are fitted when a session first asks, on FIT_SNIPPETS invented snippets that run through the
same expressions; the thresholds are those that reach PRECISION on the held-out half of them. Cues stand
before some snippets that are nothing personal and are missing before some that are, so no feature alone
separates them.
"""

from __future__ import annotations

import random
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Each is the contract's pattern in a form that Java's engine runs in
# linear time: a match starts only where a run starts, and runs are possessive.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Proposals beside the base, two for each kind: a narrow and a wide form.
PROPOSALS = {
    "email": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\[at\]|\(at\)|\{at\}|\bAT\b| at |＠) ?[A-Za-z0-9-]++(?: ?(?:\[dot\]|\(dot\)|\{dot\}| dot |\.) ?[A-Za-z0-9-]++)++",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:[ \t]{1,2}@[ \t]{0,2}|@[ \t]{1,2})[A-Za-z0-9-]++(?:[ \t]{0,2}\.[ \t]{0,2}[A-Za-z0-9-]++)++",
    ),
    "ip": (
        r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:.])",
        r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}|[0-9]{1,3}(?: ?(?:\[\.\]|\(\.\)) ?[0-9]{1,3}){3})(?![0-9A-Za-z:.])",
    ),
    "card": (
        r"(?<![0-9./_])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9./_])",
        r"(?<![0-9])(?<![0-9][ ./_\t\u00a0\u2013-])[0-9](?:[ ./_\t\u00a0\u2013-]?+[0-9]){12,18}+(?![ ./_\t\u00a0\u2013-]?[0-9])",
    ),
    "phone": (
        r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,5}(?![0-9A-Za-z]|[.-][0-9])",
        r"(?<![0-9A-Za-z+.-])\(?0[0-9]{1,4}\)?(?:[ /-]{1,2}[0-9]{2,8}){1,4}(?![0-9A-Za-z]|[./-][0-9])",
    ),
}
#: Words that speak for a kind shortly before a span; fixed values.
CUES = {
    "email": ("mail", "contact", "write", "reach", "correo", "kontakt"),
    "ip": ("ip", "host", "server", "address", "login", "from"),
    "card": ("card", "visa", "credit", "payment", "tarjeta", "karte", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "whatsapp", "móvil", "handy"),
}
#: Words that speak for a plain number; fixed values.
AGAINST = ("order", "invoice", "version", "isbn", "serial", "ref", "part", "date", "page", "item", "build")
#: Characters before a span, back to the same pattern's last match at most, in which words are looked for.
CONTEXT = 32

FEATURES = (
    "kind", "length", "digits", "others", "distinct_digits", "luhn", "cue", "against", "letters_around",
    "brackets", "dots", "hyphens", "spaces", "top_domain", "colons", "wide", "groups", "slashes",
)
FIT_SNIPPETS, ROUNDS, DEPTH, RATE, PRECISION = 3200, 40, 3, 0.3, 0.98
#: Spans that a running fold takes at a time.
CHUNK = 64

_NO_SPANS = "cast(array() as array<struct<start:bigint,end:bigint,hit:string,before:string,after:string>>)"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _chunks(items: Column) -> Column:
    last = F.floor((F.size(items) - 1) / F.lit(CHUNK)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(items, c * CHUNK + 1, CHUNK))


def _running(items: Column, zero: Column, step: Callable, tell: Callable, kind: str) -> Column:
    """tell(state, item) for each item, state being the fold by ``step`` of the items before; an array of ``kind``.

    Each chunk's first state comes from a fold over the chunks, so no list grows by one item at a time.
    """
    none = lambda of: F.expr(f"cast(array() as array<{of}>)")

    def of_chunk(chunk: Column, first: Column) -> Column:
        begin = F.struct(first.alias("state"), none(kind).alias("out"))
        more = lambda h, x: F.struct(step(h["state"], x).alias("state"), F.concat(h["out"], F.array(tell(h["state"], x))).alias("out"))
        return F.aggregate(chunk, begin, more, lambda h: h["out"])

    def walk(chunks: Column) -> Column:
        begin = F.struct(zero.alias("state"), none("bigint").alias("firsts"))
        more = lambda h, c: F.struct(F.aggregate(c, h["state"], step).alias("state"), F.concat(h["firsts"], F.array(h["state"])).alias("firsts"))
        return F.flatten(F.zip_with(chunks, F.aggregate(chunks, begin, more, lambda h: h["firsts"]), of_chunk))

    return _let(items, lambda held: F.when(F.size(held) > 0, _let(_chunks(held), walk)).otherwise(none(kind)))


def _spans(text: Column, pattern: str, cheap: Column | None = None) -> Column:
    """array<struct<start bigint, end bigint, hit, before, after string>> of a pattern's leftmost matches;
    before and after: up to CONTEXT characters, and one, that no match holds."""

    def places(gaps: Column) -> Column:
        n = F.size(gaps) - 1

        def piece(gap: Column, pair: Column) -> Column:
            hit, after = pair["hit"], pair["next"]
            return F.struct(
                F.length(gap).cast("long").alias("skip"), F.length(hit).cast("long").alias("long"), hit.alias("hit"),
                F.substring(gap, F.lit(-CONTEXT), F.lit(CONTEXT)).alias("before"), F.substring(after, 1, 1).alias("after"),
            )

        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        pairs = F.zip_with(hits, F.slice(gaps, 2, n), lambda h, g: F.struct(h.alias("hit"), g.alias("next")))
        return F.zip_with(F.slice(gaps, 1, n), pairs, piece)

    def tell(at: Column, x: Column) -> Column:
        start = at + x["skip"]
        return F.struct(start.alias("start"), (start + x["long"]).alias("end"), x["hit"].alias("hit"), x["before"].alias("before"), x["after"].alias("after"))

    kind = _NO_SPANS.removeprefix("cast(array() as array<").removesuffix(">)")
    found = _running(
        _let(F.split(text, pattern, -1), places), F.lit(0).cast("long"), lambda at, x: at + x["skip"] + x["long"], tell, kind
    )
    some = F.regexp_like(text, F.lit(pattern)) if cheap is None else cheap
    return F.when(some, found).otherwise(F.expr(_NO_SPANS))


def _luhn(digits: Column) -> Column:
    back = F.split(F.reverse(digits), "")

    def value(d: Column, i: Column) -> Column:
        n = F.try_to_number(d, F.lit("9")).cast("int")
        twice = F.when(n > 4, n * 2 - 9).otherwise(n * 2)
        return F.when(i % 2 == 1, twice).otherwise(n)

    return F.aggregate(F.transform(back, value), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _small(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))


_CHECKS = {
    "email": lambda hit: F.lit(True),
    "ip": lambda hit: F.forall(F.split(hit, "[.]"), _small),
    "card": lambda hit: _luhn(_digits(hit)),
    "phone": lambda hit: F.length(_digits(hit)).between(9, 15),
}


def _base(text: Column, kind: str) -> Column:
    cheap = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind)
    found = _spans(text, BASE[kind], cheap)
    return F.filter(found, lambda s: _CHECKS[kind](s["hit"]))


def _features(kind: str, wide: int, span: Column) -> list[Column]:
    hit, before = span["hit"], F.lower(span["before"])
    digits = _digits(hit)
    around = F.concat(F.substring(before, F.lit(-1), F.lit(1)), span["after"])
    count = lambda chars: F.length(hit) - F.length(F.translate(hit, chars, ""))
    told = lambda words: F.regexp_like(before, F.lit(r"\b(?:" + "|".join(words) + ")")).cast("int")
    return [
        F.lit(KINDS.index(kind)),
        F.length(hit),
        F.length(digits),
        F.length(hit) - F.length(digits),
        F.size(F.array_distinct(F.split(digits, ""))),
        _luhn(digits).cast("int"),
        told(CUES[kind]),
        told(AGAINST),
        F.regexp_like(around, F.lit("[A-Za-z0-9]")).cast("int"),
        count("()[]{}"),
        count("."),
        count("-"),
        count(" "),
        F.regexp_like(hit, F.lit(r"(?i)(?:com|org|net|edu|io|de|fr|es|info)$")).cast("int"),
        count(":"),
        F.lit(wide),
        F.size(F.regexp_extract_all(hit, F.lit("[0-9]++"), F.lit(0))),
        count("/"),
    ]


_FAR = 1 << 60
_PLACE = "start:bigint,end:bigint,kind:int,wide:int,hit:string,before:string,after:string"


def _free(base: Column, proposed: Column) -> Column:
    """The proposals that no base span overlaps: of all spans in order, none that starts before reaches into
    one, and none that starts later starts inside one."""
    blank = F.lit("")
    told = F.transform(
        base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(-1).alias("kind"), F.lit(0).alias("wide"), blank.alias("hit"), blank.alias("before"), blank.alias("after"))
    )
    fields = [f.split(":")[0] for f in _PLACE.split(",")]
    with_ = lambda x, **more: F.struct(*[x[f].alias(f) for f in fields], *[v.alias(k) for k, v in more.items()])
    own = lambda x, at, end, other: F.when(x["kind"] < 0, at(end, other)).otherwise(end)
    reached = _running(
        F.array_sort(F.concat(told, proposed)), F.lit(0).cast("long"), lambda end, x: own(x, F.greatest, end, x["end"]),
        lambda end, x: with_(x, reach=end), f"struct<{_PLACE},reach:bigint>",
    )
    next_ = _running(
        F.reverse(reached), F.lit(_FAR).cast("long"), lambda at, x: own(x, F.least, at, x["start"]),
        lambda at, x: with_(x, free=(x["kind"] >= 0) & (x["reach"] <= x["start"]) & (at >= x["end"])), f"struct<{_PLACE},free:boolean>",
    )
    return F.transform(F.filter(next_, lambda x: x["free"]), lambda x: with_(x))


def _proposed(text: Column, base: Column) -> Column:
    """array<struct<kind, start, end, x>> of all proposals that no base span overlaps."""

    def of(kind: str, wide: int) -> Column:
        # Without an @ the wide form of an address is nowhere.
        return F.transform(
            _spans(text, PROPOSALS[kind][wide], F.contains(text, F.lit("@")) if (kind, wide) == ("email", 1) else None),
            lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), F.lit(KINDS.index(kind)).alias("kind"), F.lit(wide).alias("wide"),
                s["hit"].alias("hit"), s["before"].alias("before"), s["after"].alias("after"),
            ),
        )

    def features(s: Column) -> Column:
        told = [(k, w) for k in KINDS for w in (0, 1)]
        x = None
        for k, w in told:
            mine = F.array(*[f.cast("double") for f in _features(k, w, s)])
            here = (s["kind"] == KINDS.index(k)) & (s["wide"] == w)
            x = F.when(here, mine) if x is None else x.when(here, mine)
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), x.alias("x"))

    def told(found: Column) -> Column:
        return F.transform(F.when((F.size(base) > 0) & (F.size(found) > 0), _free(base, found)).otherwise(found), features)

    return _let(F.concat(*[of(kind, wide) for kind in KINDS for wide in (0, 1)]), told)


def _taken(over: Column) -> Column:
    """Of array<struct<score, kind, start, end>> those that are taken in the order of their scores (of equal
    ones the first in the text, then by kind), each unless it overlaps one taken before. Spans that reach
    into each other in a row are decided together; the others apart."""
    fields = ["score", "kind", "start", "end"]
    told = lambda s, *more: F.struct(*[s[f].alias(f) for f in fields], *more)

    def clusters(spans: Column) -> Column:
        n = F.size(spans)
        starts = F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at(spans, i)["fresh"])
        return _let(
            starts,
            lambda at: F.transform(
                at, lambda lo, i: F.slice(spans, lo, F.coalesce(F.get(at, i + 1), n + 1) - lo)
            ),
        )

    def greedy(cluster: Column) -> Column:
        order = F.array_sort(
            F.transform(cluster, lambda s: F.struct((-s["score"]).alias("least"), s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["score"].alias("score")))
        )
        none = F.expr("cast(array() as array<struct<score:double,kind:int,start:bigint,end:bigint>>)")

        def more(held: Column, s: Column) -> Column:
            meets = F.exists(held, lambda d: (d["start"] < s["end"]) & (s["start"] < d["end"]))
            return F.when(meets, held).otherwise(F.concat(held, F.array(told(s))))

        return F.aggregate(order, none, more)

    in_order = F.array_sort(F.transform(over, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["score"].alias("score"))))
    marked = _running(
        in_order, F.lit(0).cast("long"), lambda end, s: F.greatest(end, s["end"]),
        lambda end, s: told(s, (s["start"] >= end).alias("fresh")), "struct<score:double,kind:int,start:bigint,end:bigint,fresh:boolean>",
    )
    return F.flatten(F.transform(_let(marked, clusters), greedy))


# --- boosting ---------------------------------------------------------------------------------------


def _tree(x: np.ndarray, pull: np.ndarray, weight: np.ndarray, depth: int):
    """A regression tree over Newton steps: a leaf's value, or (feature, edge, below, above)."""
    best, leaf = None, float(pull.sum() / (weight.sum() + 1.0))
    if depth and len(x) > 8:
        whole = pull.sum() ** 2 / (weight.sum() + 1.0)
        for f in range(x.shape[1]):
            for edge in np.unique(x[:, f])[:-1]:
                low = x[:, f] <= edge
                gain = sum(pull[s].sum() ** 2 / (weight[s].sum() + 1.0) for s in (low, ~low)) - whole
                if gain > 1e-6 and (best is None or gain > best[0] + 1e-12):
                    best = (gain, f, float(edge), low)
    if best is None:
        return leaf
    _, f, edge, low = best
    return (f, edge, _tree(x[low], pull[low], weight[low], depth - 1), _tree(x[~low], pull[~low], weight[~low], depth - 1))


def _value(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, edge, low, high = tree
    return np.where(x[:, f] <= edge, _value(low, x), _value(high, x))


def boost(x: np.ndarray, y: np.ndarray) -> list:
    """Trees whose values add up to the log odds."""
    trees, score = [], np.zeros(len(y))
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        tree = _tree(x, y - p, p * (1 - p), DEPTH)
        trees.append(tree)
        score += RATE * _value(tree, x)
    return trees


def log_odds(trees: list, x: np.ndarray) -> np.ndarray:
    return RATE * sum(_value(t, x) for t in trees)


def _case(tree, x: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    f, edge, low, high = tree
    return F.when(x[f] <= edge, _case(low, x)).otherwise(_case(high, x))


def _with_check(body: str, good: bool, rng: random.Random) -> str:
    """The digits and one more, by which they pass Luhn's check or don't."""
    total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(body), 1))
    return body + str((-total) % 10 if good else (-total + rng.randint(1, 9)) % 10)


def snippets(n: int = FIT_SNIPPETS, seed: int = 5) -> list[tuple[str, int, int]]:
    """(text, kind, 1 if the span in it is personal data), invented; a text holds one proposal.

    What is not personal has the forms that number-like things in documents have: dates, versions, orders,
    hashes, times, prose with "at", numbers that fail Luhn's check.
    """
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(2, 8)))
    number = lambda k: "".join(rng.choices("0123456789", k=k))
    hexes = lambda k: "".join(rng.choices("0123456789abcdef", k=k))
    top = lambda: rng.choice(["com", "org", "net", "de", "fr", "es", "io", "museum", "co"])
    found = []
    for i in range(n):
        kind, good = KINDS[i % 4], i // 4 % 2
        if kind == "email" and good:
            name = rng.choice([f"{word()}.{word()}", f"{word()}{number(2)}", f"{word()}_{word()}", f"{word()}.{number(2)}"])
            at, dot = rng.choice([("[at]", "[dot]"), ("(at)", "(dot)"), (" [at] ", "."), ("(at)", "."), (" at ", " dot "), (" @ ", "."), (" @ ", " . "), ("@ ", ".")])
            hit = f"{name}{at}{word()}{dot}{top()}"
        elif kind == "email":
            hit = rng.choice([f"{word()} at {word()}.{word()}", f"{word()} at {word()}. {word()}", f"{word()} at {number(2)}.{number(2)}", f"{number(2)} @ {number(1)}.{number(2)}", f"{word()} @ {number(2)}.{number(2)}", f"{word()} at {word()}.{top()}"])
        elif kind == "ip" and good:
            bytes_ = [str(rng.randint(1, 254)) for _ in range(4)]
            hit = rng.choice([":".join(hexes(4) for _ in range(8)), rng.choice(["[.]", " [.] ", "(.)"]).join(bytes_), f"fe80::{hexes(4)}:{hexes(4)}:{hexes(4)}:{hexes(4)}", f"2001:db8:{hexes(4)}::{hexes(2)}"])
        elif kind == "ip":
            hit = rng.choice([":".join(hexes(2) for _ in range(8)), f"{number(1)}::{number(1)}", f"{hexes(2)}::{hexes(1)}", "(.)".join(number(1) for _ in range(4)), ":".join(number(2) for _ in range(8))])
        elif kind == "card":
            digits = _with_check(number(15), bool(good), rng)
            sep = rng.choice(["./_\t\u00a0\u2013"[rng.randrange(6)]] * 3 + ["."])
            hit = sep.join(digits[j : j + 4] for j in range(0, 16, 4))
            if not good and rng.random() < 0.4:
                y = f"20{number(2)}"
                hit = rng.choice([f"{y}.{number(2)}.{number(2)}.{number(6)}", f"{number(3)}.{number(3)}.{number(3)}.{number(3)}.{number(2)}", f"{y}/{number(2)}/{number(2)} {number(2)} {number(2)} {number(3)}"])
        elif good:
            sep = rng.choice(" .-")
            hit = rng.choice([f"({number(3)}) {number(3)}-{number(4)}", sep.join([number(3), number(3), number(4)]), f"0{number(3)}/{number(7)}", f"0{rng.randint(1, 9)} {number(2)} {number(2)} {number(2)} {number(2)}", f"(0{number(2)}) {number(4)} {number(4)}"])
        else:
            sep = rng.choice(" .-")
            hit = rng.choice([f"{number(2)}-{number(4)}-{number(4)}", sep.join([number(3), number(3), number(3)]), f"0{number(1)}/{number(2)}/20{number(2)}", f"0{number(1)}-{number(2)}-20{number(2)}", f"20{number(2)} {number(3)} {number(3)}", f"{number(3)} {number(3)} {number(4)}"])
        cue = ""
        if rng.random() < (0.75 if good else 0.08):
            cue = rng.choice(CUES[kind]) + rng.choice([": ", " ", " me at ", " is "])
        elif rng.random() < (0.04 if good else 0.5):
            cue = rng.choice(AGAINST) + " "
        found.append((f"{word()} {word()}, {cue}{hit} {word()} {word()}.", KINDS.index(kind), good))
    return found


_FITTED: dict[str, tuple[list, list[float]]] = {}


def fitted(spark: SparkSession) -> tuple[list, list[float]]:
    """The trees and each kind's threshold on the log odds, fitted once for a session."""
    key = spark.sparkContext.applicationId
    if key not in _FITTED:
        x, y, kind, text = features_of(spark, snippets())
        # A snippet's proposals are all on one side.
        held = text // 8 % 2 == 1
        trees = boost(x[~held], y[~held])
        edges = []
        for k in range(len(KINDS)):
            mine = held & (kind == k)
            score, truth = log_odds(trees, x[mine]), y[mine]
            good = [e for e in np.unique(score) if truth[score >= e].mean() >= PRECISION]
            edges.append(max(0.0, float(min(good))) if good else float("inf"))
        _FITTED[key] = (trees, edges)
    return _FITTED[key]


def features_of(spark: SparkSession, told: list[tuple[str, int, int]]) -> tuple[np.ndarray, ...]:
    """(x, good, kind, number of the snippet) of the proposals in snippets (text, kind, good). A proposal of
    another kind than the snippet's is nothing personal of its kind."""
    source = spark.createDataFrame([(i, *t) for i, t in enumerate(told)], "i int, text string, of int, good int").coalesce(1)
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    rows = (
        source.withColumn("span", F.explode(_proposed(F.col("text"), none)))
        .select("i", "span.x", "span.kind", F.when(F.col("span.kind") == F.col("of"), F.col("good")).otherwise(0).alias("good"))
        .orderBy("i", "kind", "x")
        .collect()
    )
    return (
        np.array([r["x"] for r in rows]), np.array([r["good"] for r in rows], float),
        np.array([r["kind"] for r in rows]), np.array([r["i"] for r in rows]),
    )


# --- operator ---------------------------------------------------------------------------------------


def with_spans(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """docs with _base_spans and _spans, arrays of struct<kind int, start bigint, end bigint> by kind
    (as in KINDS) and start; places in code points, end exclusive. _spans holds the base and what the
    trees add. A null text counts as empty. No other column is read and none is renamed."""
    trees, edges = fitted(docs.sparkSession)
    text = F.coalesce(F.col(text_column), F.lit(""))
    named = lambda k: lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    base = F.concat(*[F.transform(_base(text, kind), named(k)) for k, kind in enumerate(KINDS)])
    found = docs.withColumn("_base_spans", base)
    proposed = F.transform(
        _proposed(text, F.col("_base_spans")),
        lambda s: F.struct(
            F.aggregate(
                F.array(*[_case(t, s["x"]) for t in trees]), F.lit(0.0), lambda a, v: a + v, lambda a: a * F.lit(RATE)
            ).alias("score"),
            s["kind"].alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
        ),
    )
    edge = F.array(*[F.lit(e) for e in edges])
    found = found.withColumn("_over", F.filter(proposed, lambda s: s["score"] >= edge[s["kind"]]))
    added = F.when(F.size("_over") > 1, _taken(F.col("_over"))).otherwise(F.col("_over"))
    bare = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    spans = F.when(F.size("_over") > 0, F.array_sort(F.concat("_base_spans", F.transform(added, bare)))).otherwise(
        F.col("_base_spans")
    )
    return found.withColumn("_spans", spans).drop("_over")


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def find(docs: DataFrame) -> DataFrame:
    """doc_id long, n_email, n_ip, n_card, n_phone (long, of the base), base_sha256, spans: a row a row.

    Repeated rows and rows with a null doc_id return each; an empty table gives no rows.
    """
    spans = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    of = lambda k: F.size(F.filter("_base_spans", lambda s: s["kind"] == k)).cast("long")
    return spans.select(
        "doc_id",
        *[of(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(_written(F.col("_base_spans")), 256).alias("base_sha256"),
        _written(F.col("_spans")).alias("spans"),
    )


def redact(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """docs with every span of the text replaced by its kind in brackets, overlapping spans by the
    first one's. A null text stays null; all columns stay in their order."""
    whole = F.coalesce("text", F.lit(""))
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    order = F.array_sort(
        F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    marked = _running(
        order, F.lit(0).cast("long"), lambda end, s: F.greatest(end, s["end"]),
        lambda end, s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), end.alias("at")),
        "struct<start:bigint,end:bigint,kind:int,at:bigint>",
    )
    piece = lambda of, lo, hi: F.substring(of, (lo + 1).cast("int"), (hi - lo).cast("int"))

    def of_chunk(chunk: Column) -> Column:
        # The chunk's own part of the text is cut out first, so places are looked up in that alone.
        first = F.element_at(chunk, 1)["at"]
        part = piece(whole, first, F.element_at(chunk, -1)["start"])
        each = lambda own: F.transform(chunk, lambda s: F.concat(piece(own, s["at"] - first, s["start"] - first), tags[s["kind"]]))
        return F.array_join(_let(part, each), "")

    def told(spans: Column) -> Column:
        fresh = F.filter(spans, lambda s: s["start"] >= s["at"])
        end = F.array_max(F.transform(spans, lambda s: s["end"]))
        rest = F.substring(whole, (end + 1).cast("int"), F.length(whole))
        return F.concat(F.array_join(F.transform(_let(fresh, _chunks), of_chunk), ""), rest)

    clean = F.when(F.size("_spans") > 0, _let(marked, told)).otherwise(F.col("text"))
    # The row travels as one struct, so no name of a column of docs can clash.
    source = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_column].alias("text"))
    found = with_spans(source).withColumn("clean", clean)
    return found.select(*[F.col("clean" if c == text_column else f"row.`{c}`").alias(c) for c in docs.columns])
