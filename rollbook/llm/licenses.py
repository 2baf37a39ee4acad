"""License scans by ordered signature rules, with DataFrame functions only.

Texts are brought to a plain form: lower-case words with one blank between them and around. Rules are regular expressions on that form. A first pass
over all texts looks for the keywords of all rules at once; only texts with a keyword go on, and there only rules whose own keyword occurs are
tried. Every detection has the rule's priority. A detection inside a longer one of at least its priority is suppressed, and of detections over the same words only the one of
the highest priority (then the first rule) stays. Base phrases are counted at every place and always stay.

Cases: the work grows with a very long text's size and its places' number, not with their squares; a null or empty text has no words and no detections; repeated rows are scanned each; null ids are carried; an empty table gives an empty
table; the result has the columns named in ``keep`` and no other column of the input, so none can clash.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, lower_ascii, running_sums

#: What stands between words: ASCII but letters and digits.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Families written by hand: label, names as regular expressions on the plain form (versions are apart from names), and version patterns.
_V = r"(?: (?:version|v|ver))?"
FAMILIES: list[tuple[str, list[str], list[str]]] = [
    ("mit", [r"mit", r"expat", r"x11"], []),
    ("apache", [r"apache(?: software)?"], [r"1 0", r"1 1", r"2 0", r"2"]),
    ("gpl", [r"gpl", r"gnu gpl", r"gnu general public"], [r"1 0", r"2 0", r"2", r"3 0", r"3"]),
    ("lgpl", [r"lgpl", r"gnu lgpl", r"(?:gnu )?(?:lesser|library) general public"], [r"2 0", r"2 1", r"3 0", r"3"]),
    ("agpl", [r"agpl", r"gnu agpl", r"(?:gnu )?affero general public"], [r"1 0", r"3 0", r"3"]),
    ("bsd", [r"bsd", r"berkeley software distribution", r"(?:new|revised|simplified|modified) bsd"], [r"2 clause", r"3 clause", r"4 clause", r"0 clause"]),
    ("mpl", [r"mpl", r"mozilla public"], [r"1 0", r"1 1", r"2 0"]),
    ("epl", [r"epl", r"eclipse public"], [r"1 0", r"2 0"]),
    ("cddl", [r"cddl", r"common development and distribution"], [r"1 0", r"1 1"]),
    ("cpl", [r"common public"], [r"1 0"]),
    ("eupl", [r"eupl", r"european union public"], [r"1 0", r"1 1", r"1 2"]),
    ("artistic", [r"artistic", r"perl artistic"], [r"1 0", r"2 0"]),
    ("boost", [r"bsl 1 0", r"boost software"], [r"1 0"]),
    ("isc", [r"isc", r"internet systems consortium"], []),
    ("zlib", [r"zlib", r"zlib libpng"], []),
    ("unlicense", [r"(?:the )?unlicense"], []),
    ("wtfpl", [r"wtfpl", r"do what the fuck you want to public"], [r"1 0", r"2 0", r"2"]),
    ("cc0", [r"cc0", r"creative commons zero", r"creative commons cc0"], [r"1 0"]),
    ("cc-by", [r"cc by", r"creative commons attribution"], [r"2 0", r"2 5", r"3 0", r"4 0"]),
    ("cc-by-sa", [r"cc by sa", r"creative commons attribution share ?alike"], [r"2 0", r"2 5", r"3 0", r"4 0"]),
    ("cc-by-nc", [r"cc by nc", r"creative commons attribution non ?commercial"], [r"2 0", r"2 5", r"3 0", r"4 0"]),
    ("cc-by-nd", [r"cc by nd", r"creative commons attribution no ?deriv(?:ative)?s?"], [r"2 0", r"3 0", r"4 0"]),
    ("cc-by-nc-sa", [r"cc by nc sa", r"creative commons attribution non ?commercial share ?alike"], [r"2 0", r"3 0", r"4 0"]),
    ("ofl", [r"ofl", r"sil open font", r"open font"], [r"1 0", r"1 1"]),
    ("python", [r"psf", r"python software foundation", r"python"], [r"2 0", r"2"]),
    ("php", [r"php"], [r"3 0", r"3 01"]),
    ("ruby", [r"ruby"], []),
    ("openssl", [r"openssl", r"openssl ssleay"], []),
    ("postgresql", [r"postgresql"], []),
    ("ms-pl", [r"ms pl", r"microsoft public"], []),
    ("ms-rl", [r"ms rl", r"microsoft reciprocal"], []),
    ("upl", [r"upl", r"universal permissive"], [r"1 0"]),
    ("odbl", [r"odbl", r"open database"], [r"1 0"]),
    ("sspl", [r"sspl", r"server side public"], [r"1", r"1 0"]),
    ("busl", [r"busl", r"business source"], [r"1 0", r"1 1"]),
    ("elastic", [r"elastic"], [r"2 0", r"2"]),
    ("cecill", [r"cecill(?: [bc])?"], [r"1 0", r"2 0", r"2 1"]),
    ("afl", [r"afl", r"academic free"], [r"2 1", r"3 0"]),
    ("osl", [r"osl", r"open software"], [r"2 1", r"3 0"]),
    ("ncsa", [r"ncsa", r"university of illinois ncsa open source"], []),
    ("vim", [r"vim"], []),
    ("curl", [r"curl"], []),
    ("w3c", [r"w3c(?: software(?: notice and)?)?"], []),
    ("blueoak", [r"blue oak model"], [r"1 0 0"]),
    ("json", [r"json"], []),
    ("beerware", [r"beerware", r"beer ware"], []),
]
#: Sentences of license texts and notices: label, expression, and a keyword of it.
SENTENCES = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", "hereby granted"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies", "permission notice"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose", "permission to use"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification", "redistribution and use"),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice", "redistributions in binary"),
    ("bsd", r"neither the name of (?:\S+ ){1,12}nor the names of (?:its|their) contributors", "nor the names"),
    ("apache", r"licensed under the apache license", "apache"),
    ("apache", r"unless required by applicable law or agreed to in writing software", "applicable law"),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "free software"),
    ("gpl", r"see the gnu general public license for more details", "general public"),
    ("lgpl", r"this library is free software you can redistribute it and or modify it", "free software"),
    ("agpl", r"under the terms of the gnu affero general public license", "affero"),
    ("mpl", r"this source code form is subject to the terms of the mozilla public license", "mozilla"),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse"),
    ("boost", r"distributed under the boost software license", "boost"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "express or implied"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("cc0", r"the person who associated a work with this deed has dedicated the work to the public domain", "public domain"),
    ("cc-by", r"this work is licensed under a creative commons attribution", "creative commons"),
    ("public-domain", r"(?:released|placed|dedicated|is)(?: \S+){0,3} (?:in|into|to) the public domain", "public domain"),
    ("proprietary", r"all rights reserved", "rights reserved"),
    ("proprietary", r"(?:confidential and proprietary|proprietary and confidential)", "proprietary"),
    ("proprietary", r"unauthorized (?:copying|use|reproduction|distribution) of this (?:file|software|work|document)", "unauthorized"),
    ("ofl", r"this font software is licensed under the sil open font license", "open font"),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document", "permitted to copy"),
]


#: A rule on a name alone is tried only in a text that speaks of a license or of terms; names with a version and sentences are tried on their own keyword.
HINTS = ["license", "licence", "licensed", "licenced", "licenses", "licences", "released", "distributed", "available", "covered", "governed"]


def _any_of(words: list[str]) -> str:
    """One expression for whole words or phrases, branching on their first letter."""
    by: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        by.setdefault(w[0], []).append(re.escape(w[1:]))
    return "(?<= )(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by.items()) + ")(?= )"


def rules() -> list[dict]:
    """The ordered rules: an expression on the plain form, its label, priority (higher wins) and keyword. Forms of a family: notice, name with a version, identifier, name."""
    out = [dict(label=label, pattern=p, priority=40, keyword=k) for label, p, k in SENTENCES]
    for label, names, versions in FAMILIES:
        any_ = "(?:" + "|".join(names) + ")"
        number = "(?:" + "|".join(versions) + ")" if versions else None
        for lead in (r"spdx license identifier", r"license(?:s)?(?: expression| name| id)?", r"licen[cs]ed under(?: the)?(?: terms of the)?", r"(?:released|distributed|available|covered|governed)(?: \S+)? (?:under|by)(?: the)?(?: terms of the)?"):
            out.append(dict(label=label, pattern=f"{lead} {any_}" + (f"(?:{_V} {number})?" if number else "") + r"(?: only| or later)?(?: licen[cs]e)?", priority=30, keyword=""))
        if number:
            out.append(dict(label=label, pattern=f"{any_}(?: licen[cs]e)?{_V} {number}(?: only| or later)?", priority=20, keyword=""))
        out.append(dict(label=label, pattern=f"{any_} licen[cs]e", priority=10, keyword=""))
        out += [dict(label=label, pattern=f"{name} licen[cs]es?(?: agreement| text| terms| file| header)", priority=15, keyword="") for name in names]
    # a rule of a family is tried where any of the family's names can stand
    words = {label: sorted({_keyword(n) for n in names}) for label, names, _ in FAMILIES}
    final = []
    for i, r in enumerate(out):
        for k in ([r["keyword"]] if r["priority"] == 40 else words[r["label"]]):
            final.append(dict(r, keyword=k, number=i, hint=r["priority"] not in (20, 40)))
    return final


def _keyword(name: str) -> str:
    """The first words, at most three, of the longest plain run of a name: a text without them cannot hold the name."""
    group = re.compile(r"\(\?:[^()]*\)\??")
    while group.search(name):  # groups from the inside out
        name = group.sub("\n", name)
    runs = re.split(r"\n|.\?|\[[^]]*\]", name)
    return " ".join(max((r.strip() for r in runs), key=len).split()[:3])


def plain(text: Column) -> Column:
    """Blank, words with one blank between them, blank; one blank alone for a text without words."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), GAP, " ")), F.lit(" "))


def _bounded(pattern: str) -> str:
    """Whole words: the blank before a match is outside, the one behind it is not taken."""
    return f"(?<= )(?:{pattern})(?= )"


def _blanks(s: Column) -> Column:
    return (F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))).cast("bigint")


def _places(form: Column, pattern: Column) -> Column:
    """array<struct<first, last>>: first and last word of each match of a bounded pattern. Words are counted in the text between matches, so the work grows with the text and not with its square."""
    def places(hits: Column, gaps: Column) -> Column:
        blanks = F.zip_with(gaps, hits, lambda g, h: F.struct(_blanks(g).alias("before"), F.coalesce(_blanks(h), F.lit(0).cast("bigint")).alias("inside")))
        return let(blanks, lambda b: let(running_sums(F.transform(b, lambda x: x["before"] + x["inside"])), lambda earlier: F.zip_with(
            F.slice(b, 1, F.size(hits)), F.slice(earlier, 1, F.size(hits)),
            lambda x, e: F.struct((e + x["before"] - 1).alias("first"), (e + x["before"] + x["inside"] - 1).alias("last")))))

    return let(F.regexp_extract_all(form, pattern, F.lit(0)), lambda hits: let(F.split(form, pattern, -1), lambda gaps: places(hits, gaps)))


_DETECTIONS = "array<struct<first:bigint,last:bigint,label:string,priority:int,number:int>>"
#: What a place found by a rule is; in this order of fields a place comes after all that can suppress it (``back`` and ``rank`` are the last word and the priority, negative).
_PLACE = "struct<first:bigint,back:bigint,rank:int,number:int,label:string>"
PRIORITIES = (10, 15, 20, 30, 40)


def _suppressed(places: Column, chunk: int = 128) -> Column:
    """The places that no earlier one of at least their priority contains, given in the order of ``_PLACE``. One fold: how far the places of each priority and above reach so far.
    Places are taken in chunks, so a step copies at most ``chunk`` of them."""
    reach = lambda z, p: z[f"to{p}"]
    none = F.array().cast(f"array<{_PLACE}>")

    def step(z: Column, x: Column) -> Column:
        last = -x["back"]
        covered = F.coalesce(*[F.when(-x["rank"] == p, reach(z, p) >= last) for p in PRIORITIES], F.lit(False))
        return F.struct(*[F.when(-x["rank"] >= p, F.greatest(reach(z, p), last)).otherwise(reach(z, p)).alias(f"to{p}") for p in PRIORITIES],
                        F.when(covered, z["kept"]).otherwise(F.concat(z["kept"], F.array(x))).alias("kept"))

    start = lambda z: F.struct(*[reach(z, p).alias(f"to{p}") for p in PRIORITIES], none.alias("kept"))
    add = lambda z, c: let(F.aggregate(c, start(z), step), lambda y: F.struct(
        *[reach(y, p).alias(f"to{p}") for p in PRIORITIES], F.concat(z["all"], F.array(y["kept"])).alias("all")))
    n = F.size(places)
    chunks = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / chunk).cast("int")), lambda i: F.slice(places, i * chunk + 1, chunk))).otherwise(
        F.array().cast(f"array<array<{_PLACE}>>"))
    first = F.struct(*[F.lit(-1).cast("bigint").alias(f"to{p}") for p in PRIORITIES], F.array().cast(f"array<array<{_PLACE}>>").alias("all"))
    return F.flatten(F.aggregate(chunks, first, add)["all"])


def _literal(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def scan(docs: DataFrame, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and ``n_words``, ``base`` (array<struct<first, last, label>> by first word), ``detections`` (array<struct<first, last, label, priority>>) and ``score``, of every row."""
    table = rules()
    gate = _any_of([r["keyword"] for r in table if not r["hint"]] + HINTS)
    form = docs.select(*keep, plain(F.col(text)).alias("_form"))
    n_words = F.when(F.col("_form") == "  ", F.lit(0)).otherwise(F.length("_form") - F.length(F.replace("_form", F.lit(" "), F.lit(""))) - 1).cast("bigint")
    gated = form.select(*keep, n_words.alias("n_words"), F.when(F.col("_form").rlike(gate), F.col("_form")).alias("_gated"))

    # each keyword with its rules, so that a text is searched for it once
    by: dict[str, list[int]] = {}
    for r in table:
        by.setdefault(r["keyword"], []).append(r["number"])
    one = {r["number"]: r for r in table}
    keywords = _literal([dict(word=f" {k} ", hint=all(one[n]["hint"] for n in ns), numbers=ns) for k, ns in by.items()], "array<struct<word:string,hint:boolean,numbers:array<int>>>")
    listed = _literal([dict(label=one[n]["label"], pattern=_bounded(one[n]['pattern']), priority=one[n]["priority"], hint=one[n]["hint"]) for n in range(len(one))],
                      "array<struct<label:string,pattern:string,priority:int,hint:boolean>>")

    def found_in(t: Column, hinted: Column) -> Column:
        of_label = lambda places, label: F.transform(places, lambda m: F.struct(
            m["first"].alias("first"), m["last"].alias("last"), F.lit(label).alias("label"), F.lit(50).alias("priority"), F.lit(-1).alias("number")))
        base = F.flatten(F.array(*[F.when(t.contains(f" {p} "), of_label(_places(t, F.lit(_bounded(p))), label)).otherwise(F.array().cast(_DETECTIONS)) for p, label in BASE.items()]))
        numbers = F.array_distinct(F.flatten(F.transform(F.filter(keywords, lambda k: (hinted | ~k["hint"]) & t.contains(k["word"])), lambda k: k["numbers"])))
        here = lambda n: let(F.get(listed, n), lambda r: F.when((hinted | ~r["hint"]) & F.regexp_like(t, r["pattern"]), F.transform(_places(t, r["pattern"]), lambda m: F.struct(
            m["first"].alias("first"), (-m["last"]).alias("back"), (-r["priority"]).alias("rank"), n.alias("number"), r["label"].alias("label")))).otherwise(F.array().cast(f"array<{_PLACE}>")))
        kept = let(F.sort_array(F.flatten(F.transform(numbers, here))), lambda places: _suppressed(places))
        kept = F.transform(kept, lambda x: F.struct(x["first"].alias("first"), (-x["back"]).alias("last"), x["label"].alias("label"), (-x["rank"]).alias("priority"), x["number"].alias("number")))
        return let(F.sort_array(base), lambda b: F.struct(b.alias("base"), F.sort_array(F.concat(b, kept)).alias("detections")))

    nothing = F.struct(F.array().cast(_DETECTIONS).alias("base"), F.array().cast(_DETECTIONS).alias("detections"))
    text_of = F.col("_gated")
    found = gated.select(*keep, "n_words", F.when(text_of.isNotNull(), let(text_of.rlike(_any_of(HINTS)), lambda hinted: found_in(text_of, hinted))).otherwise(nothing).alias("_found"))
    # how sure the surest detection is
    sure = F.coalesce(F.array_max(F.transform("_found.detections", lambda d: d["priority"])), F.lit(0)) / 50
    return found.select(*keep, "n_words", "_found.base", "_found.detections", F.least(F.lit(1.0), sure.cast("double")).alias("score"))
