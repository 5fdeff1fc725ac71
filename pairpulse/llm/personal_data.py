"""Personal data: fixed patterns, and identifiers found by their contexts. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairpulse.llm.common import saved, with_row_key

# The patterns of the contract, kinds in its order. A look-behind or the end
# of the last match keeps the search from starting inside a run that has just failed, and
# possessive loops from trying shorter ones; neither changes what is matched.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character without which a text cannot match.
_NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+"}
#: Kind of the identifiers that contexts tell.
CONTEXT_KIND = "id"
#: Tokens that may be identifiers: those with a digit or an at sign.
_TOKEN = r"(?<!\S)\S*?[0-9@]\S*+"
#: Shapes of secrets, which are seeds too: long hexadecimal strings with letters and digits, and
#: strings that begin as access keys do.
_SECRET = (r"(?<![A-Za-z0-9])(?:(?=[a-fA-F]*+[0-9])(?=[0-9]*+[a-fA-F])[0-9a-fA-F]{32,}+(?![A-Za-z0-9])"
           r"|(?:AKIA|AIza|gh[op]_|sk-|sk_live_|xox[a-z]-|eyJ)[A-Za-z0-9_.-]{16,}+)")
_MAY_BE_SECRET = "[0-9a-fA-F]{32}|AKIA|AIza|gh[op]_|sk[-_]|xox|eyJ"
_SECRET_KIND = "secret"
_HEAD, _TAIL = r"^[\p{Punct}&&[^+@#]]+", r"[\p{Punct}]+$"
#: Characters beside an entity in which its neighbouring word is looked for.
WINDOW = 40
#: Distinct seeds a pattern must have, patterns an identifier must have, scores both need.
LEAST_SEEDS, LEAST_PATTERNS, LEAST_SCORE = 3, 2, 0.8
#: One pattern suffices that has so many distinct seeds and this score.
STRONG_SEEDS, STRONG_SCORE = 10, 0.95
ROUNDS = 3

_SPAN = "struct<kind: string, rank: int, start: int, stop: int, hit: string, before: string, after: string>"


def _placed(text: str, pattern: str, kind: str, rank: int) -> str:
    """SQL for the matches of a pattern with their places and what stands beside them.

    Places are running sums over matches and the gaps between them. They are folded in
    blocks of the square root of their number, as arrays grow by copying.
    """
    literal = pattern.replace("\\", "\\\\").replace("'", "\\'")
    pieces = (f"transform(p.hits, (hit, i) -> named_struct('hit', hit, 'gap', length(p.gaps[i]), "
              f"'before', right(concat(coalesce(right(get(p.hits, i - 1), {WINDOW}), ''), right(p.gaps[i], {WINDOW})), {WINDOW}), "
              f"'after', left(concat(left(p.gaps[i + 1], {WINDOW}), coalesce(left(get(p.hits, i + 1), {WINDOW}), '')), {WINDOW})))")
    empty = f"cast(array() as array<{_SPAN}>)"
    inner = (f"aggregate(slice(q, 1 + k * b, b), named_struct('at', acc.at, 'found', {empty}), (own, x) -> named_struct("
             "'at', own.at + x.gap + length(x.hit), 'found', concat(own.found, array(named_struct("
             f"'kind', '{kind}', 'rank', {rank}, 'start', own.at + x.gap, 'stop', own.at + x.gap + length(x.hit), "
             "'hit', x.hit, 'before', x.before, 'after', x.after)))))")
    folded = (f"aggregate(sequence(0, size(q) div b), named_struct('at', 0, 'found', {empty}), (acc, k) -> "
              f"transform(array({inner}), r -> named_struct('at', r.at, 'found', concat(acc.found, r.found)))[0], "
              "acc -> acc.found)")
    blocked = f"transform(array(cast(ceil(sqrt(size(q) + 1)) as int)), b -> {folded})[0]"
    return (f"transform(array(named_struct('hits', regexp_extract_all({text}, '{literal}', 0), "
            f"'gaps', split({text}, '{literal}', -1))), p -> transform(array({pieces}), q -> {blocked})[0])[0]")


_OCTET = ("forall(split({m}, '[.]'), p -> case when length(regexp_replace(p, '^0+', '')) > 3 then false "
          "else cast(concat('0', regexp_replace(p, '^0+', '')) as int) <= 255 end)")
_DIGITS = "regexp_replace({m}, '[^0-9]', '')"
_LUHN = ("aggregate(sequence(1, length(d)), 0, (acc, i) -> acc + "
         "case when i % 2 = 1 then cast(substring(d, length(d) - i + 1, 1) as int) "
         "when cast(substring(d, length(d) - i + 1, 1) as int) > 4 "
         "then 2 * cast(substring(d, length(d) - i + 1, 1) as int) - 9 "
         "else 2 * cast(substring(d, length(d) - i + 1, 1) as int) end) % 10 = 0")
_VALID = {
    "email": "true",
    "ip": _OCTET.format(m="s.hit"),
    "card": f"exists(array({_DIGITS.format(m='s.hit')}), d -> length(d) between 16 and 19 and {_LUHN})",
    "phone": f"length({_DIGITS.format(m='s.hit')}) between 8 and 15",
}


def base_spans(text: str) -> Column:
    """Valid matches of all kinds in a text column, by kind and place."""
    parts = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        needs = _NEEDS[kind].replace("\\", "\\\\")
        parts.append(f"case when {text} rlike '{needs}' then filter({_placed(text, pattern, kind, rank)}, "
                     f"s -> {_VALID[kind]}) else cast(array() as array<{_SPAN}>) end")
    return F.expr(f"concat({', '.join(parts)})")


def _secrets(text: str, base: str) -> Column:
    """Strings of the shape of a secret that share nothing with a base span."""
    placed = _placed(text, _SECRET, _SECRET_KIND, len(PATTERNS))
    return F.expr(f"case when {text} rlike '{_MAY_BE_SECRET}' then filter({placed}, "
                  f"s -> not exists({base}, b -> b.start < s.stop and s.start < b.stop)) "
                  f"else cast(array() as array<{_SPAN}>) end")


def _tokens(text: str, base: str, secrets: str) -> Column:
    """Tokens that may be identifiers and share nothing with a base span or secret, without punctuation."""
    head, tail, email, ip = (x.replace("\\", "\\\\") for x in (_HEAD, _TAIL, PATTERNS["email"], PATTERNS["ip"]))
    plain = (f"filter({_placed(text, _TOKEN, CONTEXT_KIND, len(PATTERNS))}, "
             f"s -> not s.hit rlike '{email}' and not s.hit rlike '{ip}')")
    bare = f"regexp_replace(s.hit, '{head}', '')"
    trimmed = (f"transform({plain}, s -> named_struct('kind', s.kind, 'rank', s.rank, "
               f"'start', s.start + length(s.hit) - length({bare}), "
               f"'stop', s.stop - length(s.hit) + length(regexp_replace(s.hit, '{tail}', '')), "
               f"'hit', regexp_replace({bare}, '{tail}', ''), 'before', s.before, 'after', s.after))")
    spread = f"concat(filter({base}, s -> s.rank >= 2), {secrets})"
    return F.expr(f"case when {text} rlike '[0-9@]' then transform(array({spread}), w -> filter({trimmed}, s -> "
                  f"length(s.hit) >= 4 and not exists(w, b -> b.start < s.stop and s.start < b.stop)))[0] "
                  f"else cast(array() as array<{_SPAN}>) end")


def _in_context(spans: str) -> Column:
    """Spans with the words before and after them, lower case, digits as 0; what is glued to them is left out."""
    def word(piece: str, pattern: str) -> str:
        return f"regexp_replace(lower(regexp_extract({piece}, '{pattern}', 1)), '[0-9]', '0')"

    return F.expr(f"transform({spans}, s -> named_struct('kind', s.kind, 'rank', s.rank, 'start', s.start, "
                  f"'stop', s.stop, 'instance', xxhash64(lower(s.hit)), "
                  f"'two', {word('s.before', r"(\\S+\\s+\\S+)\\s+\\S*$")}, "
                  f"'left', {word('s.before', r"(\\S+)\\s+\\S*$")}, 'right', {word('s.after', r"^\\S*\\s+(\\S+)")}))")


def discovered(entities: DataFrame) -> DataFrame:
    """Instances that high-confidence patterns tell, of ``instance, kind, two, left, right``.

    Every entity is an instance; those of base kinds and secrets are seeds. A pattern is the
    word before, the two words before, the word after, or one on either side. Instances and
    patterns score one another in turn: a pattern by the mean score of its distinct
    instances, if it has ``LEAST_SEEDS`` seeds, and an unseen instance by the mean of its
    scored patterns, of which it needs ``LEAST_PATTERNS``, or by one alone that has
    ``STRONG_SEEDS`` seeds and ``STRONG_SCORE``. Seeds stay at 1. Counts are combined before
    they are moved.
    """
    seed = F.col("kind") != CONTEXT_KIND
    kinds = F.array(
        F.when(F.col("left") != "", F.concat(F.lit("l:"), "left")),
        F.when(F.col("two") != "", F.concat(F.lit("t:"), "two")),
        F.when(F.col("right") != "", F.concat(F.lit("r:"), "right")),
        F.when((F.col("left") != "") & (F.col("right") != ""), F.concat_ws(" ", F.lit("b:"), "left", "right")))
    graph = saved(entities.select("instance", seed.alias("seed"), F.explode(F.array_compact(kinds)).alias("p"))
                  .groupBy("p", "instance").agg(F.bool_or("seed").alias("seed")))
    strong = (F.col("n_seeds") >= STRONG_SEEDS) & (F.col("confidence") >= STRONG_SCORE)
    score = None
    for _ in range(ROUNDS):
        scored = graph if score is None else graph.join(score, "instance", "left")
        value = F.lit(0.0) if score is None else F.coalesce("score", F.lit(0.0))
        patterns = (scored.withColumn("_v", F.when(F.col("seed"), 1.0).otherwise(value))
                    .groupBy("p").agg(F.avg("_v").alias("confidence"),
                                      F.count(F.when(F.col("seed"), 1)).alias("n_seeds"))
                    .filter(F.col("n_seeds") >= LEAST_SEEDS))
        score = saved(graph.filter(~F.col("seed")).join(patterns, "p").groupBy("instance")
                      .agg(F.avg("confidence").alias("mean"), F.count("*").alias("n_patterns"),
                           F.max(F.when(strong, F.col("confidence"))).alias("strong"))
                      .withColumn("score", F.coalesce(
                          "strong", F.when(F.col("n_patterns") >= LEAST_PATTERNS, F.col("mean"))))
                      .filter("score is not null").select("instance", "score"))
    return score.filter(F.col("score") >= LEAST_SCORE).select("instance")


def personal_data(docs: DataFrame) -> DataFrame:
    """Personal data in each document, with its places.

    Base kinds are matched leftmost and without overlap, then checked (octets, Luhn,
    number of digits); failing matches are dropped. These and strings of the shape of a
    secret, which are of kind ``id``, are seeds: the words beside them form patterns, and
    tokens with a digit or an at sign that stand in confident patterns are identifiers of
    kind ``id``, wherever else they stand too.

    Returns ``doc_id``, the counts ``n_email, n_ip, n_card, n_phone``, ``base_sha256``
    of the base spans and ``spans`` of all: ``kind:start:end`` in code points, end
    exclusive, by kind as listed, then start, comma-joined. Null and empty texts have no
    spans. One row per row of ``docs``, also where ids are null or repeated; other columns
    are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = (with_row_key(docs, "_row").select("_row", "doc_id", text.alias("_t"))
             .withColumn("_base", base_spans("_t")).withColumn("_secret", _secrets("_t", "_base"))
             .withColumn("_more", _tokens("_t", "_base", "_secret"))
             .select("_row", "doc_id", _in_context("_base").alias("base"),
                     _in_context("_secret").alias("secret"), _in_context("_more").alias("more")))
    found = saved(found)
    entities = found.select(F.explode(F.concat("base", "secret", "more")).alias("e")).select("e.*")
    told = discovered(entities)
    more = (found.filter(F.size("more") > 0).select("_row", F.explode("more").alias("e"))
            .join(told, F.col("e.instance") == told["instance"])
            .groupBy("_row").agg(F.array_sort(F.collect_set(F.struct("e.rank", "e.start", "e.stop"))).alias("told")))
    both = found.join(more, "_row", "left")

    def written(spans: str) -> str:
        return f"concat_ws(',', transform({spans}, s -> concat_ws(':', s.kind, s.start, s.stop)))"

    secret = "transform(secret, s -> struct(s.rank, s.start, s.stop))"
    told_text = (f"concat_ws(',', transform(array_sort(concat({secret}, coalesce(told, array()))), s -> "
                 f"concat_ws(':', '{CONTEXT_KIND}', s.start, s.stop)))")
    base_text = F.expr(written("base"))
    return both.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}")
          for kind in PATTERNS),
        F.sha2(base_text, 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif(base_text, F.lit("")), F.nullif(F.expr(told_text), F.lit(""))).alias("spans"))
