"""Columns over names, captions, identifiers and model answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that place a caption's part, by kind, in the order in which they are tested.
POSITIONS = {
    "column": ["column"],
    "row": ["row"],
    "position_in_image": ["top", "bottom", "middle", "left", "right", "center", "lower", "upper", "above", "below"],
}
#: Licences that allow commercial use.
COMMERCIAL = ["CC0", "CC BY", "CC BY-ND", "CC BY-SA"]


def figure_uuid(article: Column, cluster: Column) -> Column:
    return F.concat(F.lit("PMC"), article.cast("string"), F.lit("_"), cluster)


def parse_uuid(uuid: Column) -> Column:
    """(article_id, image_cluster_id); the cluster may hold `_` itself."""
    return F.struct(F.regexp_extract(uuid, r"^PMC(\d+)_(.*)$", 1).try_cast("bigint").alias("article_id"), F.regexp_extract(uuid, r"^PMC(\d+)_(.*)$", 2).alias("image_cluster_id"))


def _whole(s: Column) -> Column:
    """The integer that a text is, white space around it and a sign allowed; else null."""
    return F.when(s.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(F.regexp_replace(s, r"\s", ""))).try_cast("int")


def figure_number(cluster: Column) -> Column:
    """(id, sub) of ids such as pone.0012-g003, gr2_lrg, fig4b; both null if none fits."""
    tail = cluster
    for mark in ("-g", "-f", ".g", "-i", "fig"):
        tail = F.substring_index(tail, mark, -1)
    own, gr = _whole(tail), _whole(F.replace(F.substring_index(cluster, "_", 1), F.lit("gr"), F.lit("")))
    short = _whole(F.left(tail, F.char_length(tail) - 1))
    return F.struct(F.coalesce(own, gr, short).alias("id"), F.when(own.isNull() & gr.isNull() & short.isNotNull(), F.right(tail, F.lit(1))).alias("sub"))


def stem(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, r"[^\p{L}]", ""))


def assignable(names: Column) -> Column:
    """All names have a stem of one letter; true without names."""
    return F.forall(names, lambda n: F.char_length(stem(n)) == 1)


_FORMS = (
    lambda s: s,
    F.lower,
    lambda s: F.regexp_replace(s, r"[^\p{L}\p{N}]", ""),
    lambda s: F.regexp_replace(s, r"[^\p{L}]", ""),
    lambda s: F.lower(F.regexp_replace(s, r"[^\p{L}\p{N}]", "")),
    stem,
)


def stripped(s: Column) -> Column:
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def match_level(text: Column, name: Column, names: Column) -> Column:
    """1 to 6: the first form in which text and name are equal, both without white space around them; forms
    after the first count only where they leave all names as they are. Null if none does."""

    def stable(form) -> Column:
        return F.forall(names, lambda n: form(n) == n)

    a, b = stripped(text), stripped(name)
    out = F.when(a == b, 1)
    for level, form in enumerate(_FORMS[1:], 2):
        out = out.when((form(a) == form(b)) & stable(form), level)
    return out


def stable_forms(names: Column) -> Column:
    """For each level of match_level whether its form leaves all names as they are; the first always counts."""
    return F.array(F.lit(True), *[_all_stay(names, form) for form in _FORMS[1:]])


def _all_stay(names: Column, form) -> Column:
    return F.forall(names, lambda n: form(n) == n)


def tagged_forms(text: Column, stable: Column | None = None) -> Column:
    """The forms of a text, each with its level; those that are not stable are left out. Two texts match on some level if
    their arrays overlap."""
    a = stripped(text)
    forms = [F.concat(F.lit(f"{i}:"), form(a)) for i, form in enumerate(_FORMS)]
    return F.array_compact(F.array(*(forms if stable is None else [F.when(F.get(stable, F.lit(i)), x) for i, x in enumerate(forms)])))


def is_alnum_token(s: Column) -> Column:
    """Letters with one digit, or digits with one letter."""
    return s.rlike(r"^([A-Za-z]+[0-9][A-Za-z]*|[0-9]+[A-Za-z][0-9]*)$")


def name_class(names: Column) -> Column:
    """What the names of a caption's parts are: full_caption, alphanum, positional (a kind of POSITIONS or null),
    ambiguous, sequential; error for a lone name other than None and for no names, where all else is false."""
    bare = F.transform(names, lambda n: F.regexp_replace(F.lower(F.replace(n, F.lit("\u0130"), F.lit(""))), "[^a-z0-9]", ""))
    n = F.size(names)
    some = n > 1
    letters = some & F.forall(bare, lambda x: x.rlike("^[a-z]$"))
    digits = some & F.forall(bare, lambda x: x.rlike("^[0-9]$"))
    tokens = some & ~letters & ~digits & F.forall(bare, is_alnum_token)
    codes = F.transform(bare, lambda x: F.ascii(x))
    differs = lambda form: F.exists(F.zip_with(bare, names, lambda x, y: x != form(y)), lambda x: x)
    kind = F.lit(None).cast("string")
    for name, words in reversed(POSITIONS.items()):
        kind = F.when(F.array_join(bare, " ").rlike("|".join(words)), name).otherwise(kind)
    lone = (n == 1) & (F.get(names, F.lit(0)) == "None")
    return F.struct(
        lone.alias("full_caption"),
        (letters | digits | tokens).alias("alphanum"),
        F.when(some & ~letters & ~digits & ~tokens, kind).alias("positional"),
        F.when(letters, differs(F.lower)).when(digits, differs(lambda y: y)).when(tokens, F.size(F.array_distinct(bare)) != n).otherwise(False).alias("ambiguous"),
        F.when(letters | digits, F.array_max(codes) - F.array_min(codes) + 1 == n).otherwise(False).alias("sequential"),
        F.when(n == 0, "no names").when((n == 1) & ~lone, "a lone name").alias("error"),
    )


def instruction_kinds(c: Column) -> Column:
    """Which instructions a caption's class (a name_class) asks for, in order; none for a full caption."""
    asks = F.array(F.lit("alphanum"), F.when(c["ambiguous"], "ambiguous"), F.when(~c["sequential"], "missing"))
    return F.when(c["full_caption"], F.array().cast("array<string>")).when(c["positional"].isNotNull(), F.array(c["positional"])).otherwise(F.array_compact(asks))


def word_distance(a: Column, b: Column) -> Column:
    """Edits between two texts word by word: each distinct word becomes one character of a private alphabet."""
    x, y = F.filter(F.split(a, r"\s+"), lambda w: w != ""), F.filter(F.split(b, r"\s+"), lambda w: w != "")

    def spelled(words: Column, every: Column) -> Column:
        letter = lambda w: F.lpad(F.hex(F.array_position(every, w) + 0xFFFF), 8, "0")
        return F.decode(F.unhex(F.array_join(F.transform(words, letter), "")), "UTF-32")

    every = F.array_distinct(F.concat(x, y))
    return F.levenshtein(spelled(x, every), spelled(y, every))


def without_space(s: Column) -> Column:
    return F.regexp_replace(s, r"\s+", "")


def caption_distance(a: Column, b: Column) -> Column:
    """Edits between two captions without white space: in full, and with the longer cut to the shorter."""
    a, b = without_space(a), without_space(b)
    n = F.least(F.char_length(a), F.char_length(b))
    return F.struct(F.levenshtein(a, b).alias("whole"), F.levenshtein(F.left(a, n), F.left(b, n)).alias("cut"), n.alias("n"))


def captions_alike(d: Column, length: Column | None = None) -> Column:
    """length: of the caption that sets the limit of the whole distance; else the shorter one's."""
    n = d["n"] if length is None else length
    return (d["whole"] < F.greatest(F.lit(5), F.ceil(n * 0.05))) | (d["cut"] < F.greatest(F.lit(2), F.ceil(d["n"] * 0.03)))


def without_number(caption: Column) -> Column:
    return F.regexp_replace(caption, r"(?i)^\s*fig(?:ure)?\.?\s*\d+[a-z]?[.:)]?\s*", "")


def is_continued(caption: Column) -> Column:
    """After the figure's number, the caption says that it continues another."""
    return without_number(caption).rlike(r"(?i)^\W*(cont\b\.?|continued\b|continuation\b)")


def reconstruct(segments: Column, whole: Column) -> Column:
    """The text of segments (start, length, literal): slices of whole, or literals."""
    return F.array_join(F.transform(segments, lambda s: F.coalesce(s["literal"], F.substring(whole, s["start"] + 1, s["length"]))), "")


def join_segments(segments: Column) -> Column:
    """Texts of segments (structs that sort by start and end, with text), null ones left out. A space stands between two unless
    the second begins with a space or punctuation, or with an opening bracket behind a space."""
    told = F.filter(segments, lambda s: s["text"].isNotNull())

    def step(acc: Column, text: Column) -> Column:
        close = text.rlike(r"^[.,;:!?)\]}\t\n ]") | (text == "") | (text.rlike(r"^[(\[{]") & acc.endswith(" "))
        return F.when(close | (acc == ""), F.concat(acc, text)).otherwise(F.concat(acc, F.lit(" "), text))

    return F.aggregate(F.transform(F.array_sort(told), lambda s: s["text"]), F.lit(""), step)


def repair_json(s: Column) -> Column:
    """s if it is JSON. Else with missing closing braces added or, if there are too many, the last character off if it is one; s
    as it is where that is no JSON either."""
    count = lambda c: F.char_length(s) - F.char_length(F.replace(s, F.lit(c), F.lit("")))
    missing = count("{") - count("}")
    mended = F.when(missing > 0, F.concat(s, F.repeat(F.lit("}"), missing))).when((missing < 0) & s.endswith("}"), F.substring(s, 1, F.char_length(s) - 1))
    # a parser stops behind the first value; inside a list nothing may follow it
    valid = lambda c: F.size(F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))).try_cast("array<variant>")) == 1
    return F.when(valid(s), s).when(valid(mended), mended).otherwise(s)


def after_thoughts(s: Column) -> Column:
    """(thoughts, answer) around the first end of a thinking block; no block: no thoughts."""
    at = F.locate("</think>", s)
    return F.when(at > 0, F.struct(F.left(s, at - 1).alias("thoughts"), F.trim(F.substring(s, at + 8, F.char_length(s))).alias("answer"))).otherwise(F.struct(F.lit(None).cast("string").alias("thoughts"), F.trim(s).alias("answer")))


def id_list(s: Column) -> Column:
    """A JSON list of ids, flat or one level deep, as array<bigint>; null if it is neither."""
    flat, deep = F.from_json(s, "array<bigint>"), F.flatten(F.from_json(s, "array<array<bigint>>"))
    return F.when(s.rlike(r"^\s*\[\s*\["), deep).otherwise(flat)


def date_number(s: Column) -> Column:
    """YYYYMMDD as a number; None gives -1."""
    return F.replace(F.replace(F.replace(s, F.lit("-"), F.lit("")), F.lit(" "), F.lit("")), F.lit("None"), F.lit("-1")).cast("int")


def attribution(title: Column, citation: Column) -> Column:
    return F.concat(F.lit("'"), F.coalesce(title, F.lit("None")), F.lit("', "), F.coalesce(citation, F.lit("None")))


def commercial_use(licence: Column) -> Column:
    return F.coalesce(licence.isin(COMMERCIAL), F.lit(False))


def panel_name(name: Column, text: Column) -> Column:
    return F.when((name.isNull() | (name == "")) & text.isNotNull(), "None").otherwise(name)


def list_path(path: Column) -> Column:
    """(path, key) of an archive's path in a file list."""
    out = path
    for gone in ("oa_package/", ".tar", ".gz"):
        out = F.replace(out, F.lit(gone), F.lit(""))
    return F.struct(out.alias("path"), F.element_at(F.split(out, "/"), -1).alias("key"))


def keywords(xml: Column) -> Column:
    """The keywords of an article's XML, sorted and joined: of each kwd element the text before its first child element; those
    without one are left out."""
    first = F.xpath(xml, F.lit("//kwd-group/kwd/node()[position() = 1][self::text()]"))
    return F.array_join(F.array_sort(F.filter(first, lambda x: x.isNotNull() & (x != ""))), ", ")


def licence_kind(origin_file: Column) -> Column:
    """Of the last part of a path: other, non_commercial or commercial."""
    name = F.substring_index(origin_file, "/", -1)
    return F.when(F.contains(name, F.lit("other")), "other").when(F.contains(name, F.lit("noncommercial")), "non_commercial").otherwise("commercial")


def plain_elements(s: Column) -> Column:
    """The elements of a JSON list that are no lists or objects themselves, as texts; null if s is no list."""
    plain = lambda x: ~F.schema_of_variant(x).startswith("ARRAY") & ~F.schema_of_variant(x).startswith("OBJECT")
    return F.transform(F.filter(F.try_parse_json(s).try_cast("array<variant>"), plain), lambda x: x.cast("string"))


def json_quotes(s: Column) -> Column:
    return F.replace(s, F.lit("'"), F.lit('"'))


def one_of(s: Column, values: list[str]) -> Column:
    """The value that s is, whatever its case; null if it is none."""
    out = F.lit(None).cast("string")
    for v in values:
        out = F.when(F.lower(s) == v.lower(), v).otherwise(out)
    return out


def class_index(labels: Column, kinds: list[str], structure: tuple[str, ...] = ("Panel", "Label")) -> Column:
    """The place of an image's only kind in kinds; -1 to skip: no image, a panel or label, no kind or several."""
    own = F.array_intersect(labels, F.array(*map(F.lit, kinds)))
    skip = F.arrays_overlap(labels, F.array(*map(F.lit, structure))) | ~F.array_contains(labels, "Image") | (F.size(own) != 1)
    return F.when(F.coalesce(skip, F.lit(True)), -1).otherwise(F.array_position(F.array(*map(F.lit, kinds)), F.get(own, F.lit(0))).cast("int") - 1)


def stamp(t: Column) -> Column:
    return F.date_format(t, "yyyyMMdd_HHmmss")


def only_answer(s: Column) -> Column:
    """What follows the end of the thinking block; null unless there is exactly one end."""
    parts = F.split(s, "</think>")
    return F.when(F.size(parts) == 2, F.trim(F.get(parts, F.lit(1))))


def corpus_terms(caption: Column, key_terms: Column, body: Column, caption_words: list[str], key_words: list[str], body_words: list[str]) -> Column:
    """Any of caption_words in the caption, any of key_words in the key terms and any of body_words in the body."""
    some = lambda c, words: F.coalesce(c.rlike("(?i)" + "|".join(words)), F.lit(False))
    return some(caption, caption_words) & some(key_terms, key_words) & some(body, body_words)


def prompt(role: Column, *parts: Column) -> Column:
    """A message of a model's prompt as JSON, null parts left out."""
    return F.to_json(F.struct(role.alias("role"), F.concat_ws("\n", *parts).alias("content")))
