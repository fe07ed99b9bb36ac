"""Personal data in texts: found, typed, and replaced by placeholders.

Direct identifiers (mail and street addresses, phone and identity numbers) have shapes.
Names have none: what is a name is learned from the whole corpus, by how strongly a term
reveals a protected person.

1. *Co-occurrence.*  A pair of capitalised words may be a name.  Terms in the place of the
   given name whose texts hold direct identifiers far more often than the corpus does
   (binomial information, in bits) and that go with several other terms, and terms that
   words of address stand before, are seeds.
2. *Contexts.*  The one or two tokens before a pair are a cue if most pairs behind them
   begin with a seed and the pairs differ.  Words of address are cues beforehand; labels,
   closings and roles ("Signed:", "agent=", "Kontakt ist", ...) are learned.
3. *Disclosure.*  The share of a term's occurrences, in its place, that a cue announces;
   for family terms also those behind a disclosing given term.  What a term leaves open
   about a person being named is -log2(share) bits.  Two terms are a name, announced or
   not, if one leaves at most half of ``BITS`` bits open and both together ``BITS``; right
   behind a cue one is enough.  Counts are of whole terms, smoothed towards the corpus' share, so a
   term seen once neither discloses nor forbids much.

In sanitised text a found value becomes a placeholder of its type; a single term that
is left but exceeds the threshold by itself is generalised to the placeholder as well.

Scale: each text is read once by the scan, which writes one small row per candidate;
counts are combined before the shuffle (a term or context with a third of all
occurrences is one row per task); only disclosing terms and cues are joined back, from
tables whose size Spark knows when it plans the join.  No term table or text is collected.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pegelwerk.llm import patterns
from pegelwerk.plans.lineage import written

SCHEMA = "doc_id long, start int, end int, typ string, wert string, given string, family string, more string, before string, before2 string, particle string, over array<string>, title boolean, near boolean"
#: What two terms of a name may leave open together.
BITS = 4.0


def plain(word: str) -> str:
    """Case, accents and one round of wrong decoding removed."""
    if word.isascii():
        return word.lower()
    try:
        word = word.encode("cp1252").decode("utf-8")
    except UnicodeError:
        pass
    return "".join(c for c in unicodedata.normalize("NFD", word.casefold()) if not unicodedata.combining(c))


def _longer(m):
    """(end, given, family, words between, particle in front) of the names that NAME can't hold, from one start."""
    if m["last"]:
        part = patterns.PARTICLE.match(m["last"])
        words = [m.span("given"), *[x for x, w in zip(m.spans("more"), m.captures("more")) if not w.endswith(".")]]
        for k, (_, end) in enumerate(words):
            whole = m.string[m.start() : end]
            if (k or "\n" in whole or part) and whole.count("\n") <= (k < 2):
                yield end, m["given"], m["last"], "|".join(m.string[a:b] for a, b in words[1 : k + 1]), part and part.group()
        return
    words = m.captures("word")
    for k, (_, end) in enumerate(m.spans("word")):
        whole = m.string[m.start() : end]
        if (k or "\n" in whole or any(b <= end for _, b in m.spans("part"))) and whole.count("\n") <= (k < 2):
            yield end, m["first"], words[k], "|".join(words[:k]), None


def _token(text: str, at: int) -> tuple[int, int]:
    """The run without spaces that ends at ``at``, or before it and spaces with at most one line break; empty if there is none."""
    end = patterns.back(text, at)
    if end < 0:
        end = at
    a = end
    while a and not text[a - 1].isspace():
        a -= 1
    return a, end


@cache
def _title(token: str) -> bool:
    k = 0
    while k < len(token) and not token[k].isalpha():
        k += 1
    return token[k:].removesuffix(".") in patterns.TITLES


def candidates(text: str, norm=plain):
    """Rows of SCHEMA after doc_id: direct identifiers, and runs of words that may be names."""
    direct = patterns.spans(text)
    for a, b, kind in direct:
        yield a, b, kind, text[a:b], *[None] * 9
    near, k, pairs = bool(direct), 0, []
    for at in patterns.pair_starts(text):
        while k < len(direct) and direct[k][1] <= at:
            k += 1
        free = direct[k][0] if k < len(direct) else len(text)
        if at >= free:
            continue
        found = []
        if m := patterns.NAME.match(text, at):
            found.append((m.end(), m["first"], m["last"], None, None))
        # after a short name a longer one goes on with a capital letter or a particle
        if (not m or patterns.goes_on(text, m.end())) and (m := patterns.LONG.match(text, at)):
            found += _longer(m)
        if not found or min(x[0] for x in found) > free:
            continue
        a, b = _token(text, at)
        one = text[a:b]
        c, d = _token(text, a) if a else (0, 0)
        before, title = norm(one), _title(one)
        before2 = f"{norm(text[c:d])} {before}" if c < d <= a and before else ""
        pairs = [x for x in pairs if x[0] > at]
        over = [x for _, x in pairs] or None
        for end, first, last, more, part in found:
            if end <= free:
                given, family = norm(first), norm(last[last.rfind("-") + 1 :])
                # "Auskunft von": the particle may belong to what stands before
                particle = f"{before} {norm(part.strip())}" if part else None
                yield at, end, "name", text[at:end], given, family, more and plain(more), before, before2, particle, over, title, near
                if more is None:
                    pairs.append((end, f"{given}\t{family}" if "," in text[at:end] else given))


def _scan():
    import pyarrow as pa

    kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.string()] * 8, pa.list_(pa.string()), pa.bool_(), pa.bool_()]
    fields = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        norm = cache(plain)
        for batch in batches:
            rows = []
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                rows += [(i, *c) for c in candidates(t, norm)]
                if len(rows) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=fields)
                    rows = []
            if norm.cache_info().currsize > 500_000:
                norm.cache_clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=fields)

    return run


def scan(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> candidates. Null ids and texts give none; whole texts are read."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.dropna().mapInArrow(_scan(), SCHEMA)


def _pairs(cands: DataFrame) -> DataFrame:
    return cands.filter((F.col("typ") == "name") & F.col("more").isNull())


def seeds(cands: DataFrame, bits: float = 5.0, least: int = 2) -> DataFrame:
    """(given): terms whose texts hold direct identifiers beyond chance, or that words of address stand before.

    What goes with a term varies if it is a quarter of its occurrences or, however many these are, leaves ``BITS`` bits open.
    No initials; no terms that stand behind capitalised words more often than before them: these are family terms;
    and no terms that mostly stand before another seed: these announce.
    """
    both = written(_pairs(cands).groupBy("given", "family").agg(F.count(F.lit(1)).alias("n"), F.count_if("near").alias("k"), F.count_if("title").alias("t")))
    terms = both.groupBy("given").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum("t").alias("t"), F.count(F.lit(1)).alias("others"), F.sum(F.col("n") * F.log2("n")).alias("same"))
    base = terms.agg((F.sum("k") / F.sum("n")).alias("b"))  # one row, whatever the corpus
    share, b = F.col("k") / F.col("n"), F.col("b")
    gain = lambda p, q: F.when(p > 0, p * F.log2(p / q)).otherwise(0.0)
    info = F.col("n") * (gain(share, b) + gain(1 - share, 1 - b))
    goes_with = F.log2("n") - F.col("same") / F.col("n")  # entropy: numbers of different ones stop growing with the corpus
    varied = (F.col("others") >= least) & ((F.col("others") >= F.col("n") / 4) | (goes_with >= BITS))
    hit = ((share > 2 * b) & (info >= bits) & varied) | (F.col("t") / (F.col("n") + 2) >= 0.125)
    known = terms.join(F.broadcast(base)).filter(hit & ~F.col("given").endswith(".") & ~F.col("given").isin(*sorted({plain(t) for t in patterns.TITLES})))
    behind = both.groupBy(F.col("family").alias("given")).agg(F.sum("n").alias("behind"))
    known = written(known.join(behind, "given", "left").filter(F.coalesce("behind", F.lit(0)) <= F.col("n")).select("given", "n"))
    before = both.join(known.select(F.col("given").alias("family")), "family", "left_semi").groupBy("given").agg(F.sum("n").alias("before"))
    return known.join(before, "given", "left").filter(F.coalesce("before", F.lit(0)) * 2 <= F.col("n")).select("given")


def counted(cands: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs that count: those that don't begin within a pair that a seed or an initial leads.

    With the family term first ("Regards, Ida Holm") it must also stand behind a seed elsewhere.
    """
    pairs = _pairs(cands).withColumn("comma", F.col("wert").contains(","))
    behind = pairs.filter(~F.col("comma")).join(known, "given", "left_semi").select("family").distinct()
    over = pairs.filter(F.col("over").isNotNull()).select("doc_id", "start", F.explode("over").alias("x")).withColumn("x", F.split("x", "\t"))
    over = over.select("doc_id", "start", F.col("x")[0].alias("given"), F.try_element_at("x", F.lit(2)).alias("family"))
    over = over.join(known.withColumn("_seed", F.lit(True)), "given", "left").join(behind.withColumn("_behind", F.lit(True)), "family", "left")
    led = over.filter((F.col("family").isNull() & (F.col("given").endswith(".") | F.col("_seed"))) | (F.col("_seed") & F.col("_behind")))
    free = pairs.join(led.select("doc_id", "start").distinct(), ["doc_id", "start"], "left_anti")
    return free.select("given", "family", "before", "before2", "title", "comma")


def cues(pairs: DataFrame, known: DataFrame, place: str) -> DataFrame:
    """(place, n, k, others): how many pairs stand behind a context, how many of them a seed leads, and how many different ones of these."""
    of = pairs.filter(F.col(place) != "").groupBy(place, "given", "family").agg(F.count(F.lit(1)).alias("n"))
    lead = F.col("lead").isNotNull()
    of = of.join(known.withColumn("lead", F.lit(True)), "given", "left")
    return of.groupBy(place).agg(F.sum("n").alias("n"), F.sum(F.when(lead, F.col("n")).otherwise(0)).alias("k"), F.count_if(lead).alias("others"))


def learned(pairs: DataFrame, known: DataFrame, share: float = 0.5, smoothing: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(before, one) and (before2, two): the contexts that are cues, by their share of pairs that a seed leads.

    The longer context's share is smoothed towards the shorter one's; as false it is kept where it contradicts it.
    """
    part = F.col("k") / (F.col("n") + smoothing)
    one = written(cues(pairs, known, "before").filter((F.col("others") > 1) & (part >= share)).select("before", part.alias("one")))
    two = cues(pairs, known, "before2").withColumn("before", F.substring_index("before2", " ", -1)).join(one, "before", "left")
    hit = (F.col("k") + smoothing * F.coalesce("one", F.lit(0.0))) / (F.col("n") + smoothing) >= share
    two = two.withColumn("two", hit & ((F.col("others") > 1) | F.col("one").isNotNull())).filter(F.col("two") | F.col("one").isNotNull())
    return one, written(two.select("before2", "two"))


class Knowledge:
    """What a corpus says about its terms: cues, and the disclosure of given and family terms."""

    def __init__(self, cands: DataFrame):
        known = written(seeds(cands))
        pairs = written(counted(cands, known))
        self.one, self.two = learned(pairs, known)
        self.terms = {role: written(t.filter(F.col("share") >= 2.0 ** -(BITS + 4))) for role, t in disclosure(self.marked(pairs)).items()}

    def marked(self, rows: DataFrame) -> DataFrame:
        """rows with ``cue``: a word of address or a learned context stands right before. The longer context decides, if it is known."""
        out = rows.join(self.one.withColumn("one", F.lit(True)), "before", "left").join(self.two, "before2", "left")
        return out.withColumn("cue", F.coalesce(F.col("title"), F.lit(False)) | F.coalesce("two", "one", F.lit(False)))


def disclosure(pairs: DataFrame, smoothing: float = 2.0, firm: float = 0.25) -> dict[str, DataFrame]:
    """"given" and "family" -> (term, n, announced, share, bits) over the pairs of a whole corpus.

    Of pairs with the family term first only announced ones count for it: "Regards, Ida" says nothing about the first word.

    ``announced`` counts occurrences behind a cue, of family terms at least the share of those behind a
    given term with a share of ``firm`` or more; ``share`` = (announced + smoothing * base) / (n + smoothing),
    where base is the corpus' share; ``bits`` is what the term tells: log2(share / base).
    """
    both = written(pairs.groupBy("given", "family", "comma").agg(F.count(F.lit(1)).alias("n"), F.count_if("cue").alias("k")))
    base = F.broadcast(both.agg((F.sum("k") / F.sum("n")).alias("base")))  # one row, whatever the corpus
    share = (F.col("announced") + smoothing * F.col("base")) / (F.col("n") + smoothing)

    def terms(rows: DataFrame, role: str, count) -> DataFrame:
        t = rows.groupBy(F.col(role).alias("term")).agg(F.sum("n").alias("n"), F.sum(count).cast("double").alias("announced"))
        t = t.join(base).withColumn("share", share)
        return t.select("term", "n", "announced", "share", F.log2(F.col("share") / F.col("base")).alias("bits"))

    given = terms(both, "given", F.col("k"))
    sure = given.filter(F.col("share") >= firm).select(F.col("term").alias("given"), F.col("share").alias("_s"))
    behind = F.when(F.col("comma"), F.col("k")).otherwise(F.greatest(F.col("k").cast("double"), F.col("n") * F.coalesce("_s", F.lit(0.0))))
    last = both.withColumn("n", F.when(F.col("comma"), F.col("k")).otherwise(F.col("n"))).filter("n > 0")
    return {"given": given, "family": terms(last.join(sure, "given", "left"), "family", behind)}


def protected(cands: DataFrame, known: Knowledge, bits: float = BITS, least: int = 2) -> DataFrame:
    """candidates -> (doc_id, start, end, typ, wert) of what must be protected, without overlaps.

    A term discloses if it was announced at all and leaves at most half of ``bits`` open.  A pair is a
    name if one of its terms discloses and both together leave at most ``bits`` open, or right behind a
    cue if one discloses.  An initial adds nothing to its family name.  Of overlapping names the
    earlier, then the longer one counts.
    """
    left = lambda role: known.terms[role].filter(F.col("share") >= 2.0**-bits).select(
        F.col("term").alias(role), (-F.log2("share")).alias(f"{role}_open"), (F.col("announced") > 0).alias(f"{role}_seen"), (F.col("announced") >= least).alias(f"{role}_sure")
    )
    half, no = bits / 2, F.lit(False)
    pairs = cands.filter(F.col("typ") == "name").drop("near", "over").join(left("given"), "given", "left").join(left("family"), "family", "left")
    given, family = (F.coalesce(F.col(f"{r}_seen") & (F.col(f"{r}_open") <= half), no) for r in ("given", "family"))
    pairs = known.marked(pairs.filter(given | family))
    part = known.two.filter("two").select(F.col("before2").alias("particle"), F.lit(True).alias("_in"))
    pairs = pairs.join(part, "particle", "left").filter(F.col("_in").isNull())
    initial = F.length("given") == 2
    letter = initial & F.col("given").endswith(".")
    # more words, a particle or a line break: the first and the last must disclose, and what is between unless the name is announced;
    # one chance announcement ("M. Miller Checksum") doesn't make a last word
    both = F.when(letter, family).otherwise(F.coalesce(F.col("given_open") + F.col("family_open") <= bits, no))
    short = both | (F.col("cue") & (family | (given & ~initial)))
    long = family & (given | letter) & F.col("family_sure")
    free = F.col("more").eqNullSafe("") | (F.col("cue") & ~F.col("wert").contains(","))
    cols = ["doc_id", "start", "end", "typ", "wert"]
    names = pairs.filter(F.when(F.col("more").isNull(), short).otherwise(long & free)).select(*cols)
    # words between, each on its own
    inner = pairs.filter(F.col("more").isNotNull() & long & ~free).select(*cols, F.explode(F.split("more", r"\|")).alias("given")).withColumn("family", F.col("given"))
    inner = inner.join(left("given").drop("given_sure", "given_seen"), "given", "left").join(left("family").drop("family_sure", "family_seen"), "family", "left")
    fits = F.coalesce(F.least("given_open", "family_open") <= half, no)
    names = names.unionByName(inner.groupBy(*cols).agg(F.min(fits).alias("ok")).filter("ok").select(*cols))
    w = Window.partitionBy("doc_id").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    names = names.withColumn("_reach", F.max("end").over(w)).filter(F.col("_reach").isNull() | (F.col("_reach") <= F.col("start")))
    return cands.filter(F.col("typ") != "name").select(*cols).unionByName(names.select(*cols))


def read(docs: DataFrame) -> DataFrame:
    """docs -> candidates, scanned once and written, since counts and decisions read them several times."""
    return written(scan(docs))


def found(docs: DataFrame) -> DataFrame:
    """docs -> distinct (doc_id, typ, wert)."""
    cands = read(docs)
    return protected(cands, Knowledge(cands)).select("doc_id", "typ", "wert").distinct()


def sanitised(docs: DataFrame, bits: float = BITS) -> DataFrame:
    """docs -> (doc_id, text, ersetzt): texts with placeholders, and how many values were replaced.

    Texts without finding stay as they are; a null text stays null.  Single terms that disclose by
    themselves (at most a quarter of ``bits`` open) are generalised too.
    """
    cands = read(docs)
    known = Knowledge(cands)
    spans = protected(cands, known, bits).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "typ"))).alias("spans"))
    strong = known.terms["given"].filter((F.col("share") >= 2.0 ** (-bits / 4)) & (F.length("term") > 2)).select(F.col("term").alias("given"))
    alone = (
        cands.filter(F.col("typ") == "name").join(strong, "given", "left_semi").groupBy("doc_id").agg(F.collect_set("given").alias("terms"))
    )

    @F.pandas_udf("struct<text string, ersetzt int>")
    def replace(texts: pd.Series, spans: pd.Series, terms: pd.Series) -> pd.DataFrame:
        out = [_replace(t, s, w) for t, s, w in zip(texts, spans, terms)]
        return pd.DataFrame(out, columns=["text", "ersetzt"])

    joined = docs.select("doc_id", "text").join(spans, "doc_id", "left").join(alone, "doc_id", "left")
    return joined.select("doc_id", replace("text", "spans", "terms").alias("r")).select("doc_id", "r.text", "r.ersetzt")


def _replace(text, spans, terms):
    import regex

    if text is None:
        return None, 0
    out, at, n = [], 0, 0
    spans = [] if spans is None else [(x["start"], x["end"], x["typ"]) for x in spans]
    for a, b, kind in spans:
        if a < at:
            continue
        out += [text[at:a], f"[{kind.upper()}]"]
        at, n = b, n + 1
    out.append(text[at:])
    if terms is not None and len(terms):
        words = {*terms}
        for i in range(0, len(out), 2):
            parts = regex.split(rf"({patterns.L}+)", out[i])
            for j in range(1, len(parts), 2):
                if plain(parts[j]) in words and parts[j][:1].isupper():
                    parts[j], n = "[NAME]", n + 1
            out[i] = "".join(parts)
    return "".join(out), n
