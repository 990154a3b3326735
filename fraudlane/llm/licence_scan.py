"""Licence scans: sparse TF-IDF cosine to templates, then nearest-ancestor directory inheritance.

A file's licence statements are its lines or sentences with a licence cue. Each distinct statement is
scored once: its terms, weighted by count and inverse template frequency, are joined by term
to the templates' weighted terms, and the products summed and normed are the cosine. The best notice
at or above ``least`` is the statement's licence, and a file's own licence is that of its best statement.

Beside the notices there are fixed forms: SPDX tags, titles, names, standard headers and the opening words of full
texts. A form counts 1.0 where it stands word for word anywhere in a text, whatever stands around it and with or without a
cue, over line ends too (a tag within its line). The patterns are tried where one of the words that every form needs stands. GNU texts name each other, so a text that opens with the
title of one is not taken for the others.

A directory's licence is that of its licence files (by name: LICENSE, LICENCE or COPYING). A file
without a licence of its own takes the one of the nearest directory above it that has one. This is resolved
once per distinct directory, by a join of its ancestor paths, and joined to the files. The top of a tree, relative
or absolute, is the directory ''. Each distinct licence of a file or directory is listed; the single one is the best.

Only DataFrame functions are used. A statement or a directory that a third of all files share is one row
on the scored side of its join.

Defined cases: null or empty text has no statement; a null path inherits nothing; ties of score go to the template last
in code point order of its name; repeated rows are judged alike and all come back; an empty table gives an empty result; columns named
like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, named_back, set_apart

#: Short notices by SPDX identifier.
TEMPLATES = (
    ("AGPL-3.0", "licensed under the gnu affero general public license version 3"),
    ("Apache-2.0", "licensed under the apache license version 2.0"),
    ("BSD-2-Clause", "licensed under the bsd 2 clause simplified license"),
    ("BSD-3-Clause", "licensed under the bsd 3 clause new license"),
    ("CC-BY-4.0", "licensed under cc by 4.0"),
    ("CC-BY-4.0", "this work is licensed under the creative commons attribution 4.0 international license"),
    ("CC-BY-NC-4.0", "licensed under cc by nc 4.0"),
    ("CC-BY-NC-4.0", "this work is licensed under the creative commons attribution noncommercial 4.0 international license"),
    ("CC-BY-SA-4.0", "licensed under cc by sa 4.0"),
    ("CC-BY-SA-4.0", "this work is licensed under the creative commons attribution sharealike 4.0 international license"),
    ("CC0-1.0", "dedicated to the public domain under cc0 1.0 universal"),
    ("GPL-2.0", "this work is licensed under the gnu general public license version 2"),
    ("GPL-3.0", "this work is licensed under the gnu general public license version 3"),
    ("ISC", "released under the isc license"),
    ("LGPL-3.0", "licensed under the gnu lesser general public license version 3"),
    ("MIT", "released under the mit license"),
    ("MIT", "licensed under the mit license"),
    ("MPL-2.0", "this source code is subject to the terms of the mozilla public license v 2.0"),
    ("Unlicense", "released into the public domain under the unlicense"),
)
#: Titles of the GNU licences, and what follows with a version.
GNU = {"GPL": "gnu general public licen[cs]e", "LGPL": "gnu (?:lesser|library) general public licen[cs]e", "AGPL": "gnu affero general public licen[cs]e"}
BREAK = "endofstatement"


def _gnu(kind: str, version: str) -> str:
    title, short, v = GNU[kind], kind.lower(), version.replace(".", r"\.") + (r"(?:\.0)?" if "." not in version else "")
    return (f" (?:{title}|{short})(?: {short})?(?: as published by the free software foundation)?(?: either)?(?: version| v)? v?{v} "
            f"| {short}v{v} | version {v} of the {title} | version {v} of the license .{{0,80}}{title} ")


def _spdx(name: str) -> str:
    words = name.lower().replace("-", " ").replace(".", r"\.")
    return rf" spdx license identifier (?:(?!{BREAK} )[a-z0-9.]+ ){{0,16}}?{words} "


#: Forms by SPDX identifier, as patterns over lower-case words between single blanks.
FORMS = {
    "AGPL-3.0": _gnu("AGPL", "3"),
    "Apache-2.0": r" apache (?:software )?licen[cs]e(?: version| v)? v?2(?:\.0)? | apache (?:version |v )?v?2(?:\.0)? licen[cs]e ",
    "BSD-2-Clause": r" bsd 2 clause | 2 clause bsd | simplified bsd licen[cs]e | redistribution and use in source and binary forms (?!.* neither the name )",
    "BSD-3-Clause": r" bsd 3 clause | 3 clause bsd | (?:new|modified|revised) bsd licen[cs]e | redistribution and use in source and binary forms .* neither the name ",
    "CC-BY-4.0": r" cc by 4\.0 | creative commons attribution 4\.0 ",
    "CC-BY-NC-4.0": r" cc by nc 4\.0 | creative commons attribution non ?commercial 4\.0 ",
    "CC-BY-SA-4.0": r" cc by sa 4\.0 | creative commons attribution share ?alike 4\.0 ",
    "CC0-1.0": r" cc0 1\.0 | cc0 public domain | creative commons zero ",
    "GPL-2.0": _gnu("GPL", "2"),
    "GPL-3.0": _gnu("GPL", "3"),
    "ISC": r" isc licen[cs]e | permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided ",
    "LGPL-2.1": _gnu("LGPL", "2.1"),
    "LGPL-3.0": _gnu("LGPL", "3"),
    "MIT": r" mit licen[cs]e | under (?:the )?(?:terms of (?:the )?)?mit | permission is hereby granted free of charge to any person obtaining a copy of this software ",
    "MPL-2.0": r" mozilla public licen[cs]e(?: version| v)? v?2(?:\.0)? | mpl v?2(?:\.0)? | mplv2(?:\.0)? ",
    "Unlicense": r" the unlicense | this is free and unencumbered software released into the public domain ",
}
FORMS = {name: pattern + "|" + _spdx(name) for name, pattern in FORMS.items()}
#: Named without any version: a licence of its own name, if no version stands elsewhere.
UNVERSIONED = "GPL"
#: What a lower-case text with any of the forms holds at least.
NEEDED = (r"licen[cs]|spdx|gpl|apache|bsd|mpl|cc0|creative|permission|redistribution|unencumbered|(?<![a-z0-9])cc[^a-z0-9]+by[^a-z0-9]"
          r"|(?<![a-z0-9])under[^a-z0-9]+(?:the[^a-z0-9]+)?(?:terms[^a-z0-9]+of[^a-z0-9]+(?:the[^a-z0-9]+)?)?mit(?![a-z0-9])")
CUE = r"(?i)licen[cs]|copyright|public domain|spdx|all rights reserved"
APART = r"\n|[.;!?]\x20+"
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
LICENCE_FILE = r"(?i)(^|/)(license|licence|copying)[^/]*$"
ADDED = ("own_licence", "own_score", "licence", "inherited_from", "own_licences", "licences")


def _weighted(terms: DataFrame, key: str, idf: DataFrame, unseen: Column) -> DataFrame:
    """(key, term, weight) with weights of norm 1 for each key; terms has (key, term), one row per use."""
    counted = terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("n")).join(idf, "term", "left")
    weighted = counted.select(key, "term", (F.col("n") * F.coalesce("idf", unseen)).alias("w"))
    norms = weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms, key).select(key, "term", (F.col("w") / F.col("norm")).alias("weight"))


def _terms(text: Column) -> Column:
    return F.explode(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))).alias("term")


def statement_scores(statements: DataFrame, templates, least: float) -> DataFrame:
    """(statement, name, score) of the distinct statements that match a template."""
    spark = statements.sparkSession
    notices = spark.createDataFrame([(k, name, body) for k, (name, body) in enumerate(templates)], "notice int, name string, body string")
    given = notices.select("notice", _terms(F.col("body")))
    n = len(templates)
    idf = given.distinct().groupBy("term").agg((F.log((1.0 + n) / (1 + F.count(F.lit(1)))) + 1).alias("idf"))
    unseen = F.log(F.lit(1.0 + n)) + 1
    models = _weighted(given, "notice", idf, unseen).select("notice", "term", F.col("weight").alias("model"))
    used = statements.select("statement", _terms(F.col("statement")))
    products = _weighted(used, "statement", idf, unseen).join(models, "term")
    scores = products.groupBy("statement", "notice").agg(F.round(F.sum(F.col("weight") * F.col("model")), 6).alias("score"))
    best = scores.join(notices.select("notice", "name"), "notice").groupBy("statement").agg(F.max(F.struct("score", "name")).alias("b"))
    return best.where(F.col("b.score") >= least).select("statement", "b.name", "b.score")


def _said_words(text: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)), " "), F.lit(" "))


def _forms(words: Column, title: Column) -> Column:
    """The licences whose forms stand in the words."""
    found = F.array_compact(F.array(*[F.when(words.rlike(pattern), F.lit(name)) for name, pattern in FORMS.items()]))
    bare = words.rlike(f" {GNU[UNVERSIONED]} ") & ~F.exists(found, lambda f: f.rlike("^L?GPL|^AGPL"))
    found = F.when(bare, F.array_append(found, F.lit(UNVERSIONED))).otherwise(found)
    return F.filter(found, lambda f: _agrees(f, title))


def _agrees(name: Column, title: Column) -> Column:
    """Whether a text that opens with the GNU title (or none: null) can have the licence."""
    kind = F.regexp_extract(name, r"^([AL]?GPL)(?:-|$)", 1)
    return title.isNull() | (kind == "") | (kind == title)


def scan_licences(files: DataFrame, templates=TEMPLATES, least: float = 0.8, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """``files`` without its text, with own_licence, own_score, licence and inherited_from (a directory, or null
    for the file's own licence), and own_licences and licences: all that the file names, and those or else all of the
    directory it inherits from, by code point. More than one there is a dual licence or a conflict."""
    files, names = set_apart(files)
    path_col, text_col, names = names[path_col], names[text_col], {c: given for c, given in names.items() if c not in ADDED}
    carried = dict.fromkeys([path_col, *(given for given in names.values() if given != text_col)])  # the path counts even where its column is replaced
    segments = F.when(F.col(text_col).rlike(CUE), F.filter(F.split(text_col, APART), lambda s: s.rlike(CUE)))
    text = F.col(text_col)
    # SPDX tags end with their line, so only statements have them.
    whole = F.regexp_replace(text, "(?i)spdx", "")
    words = F.when(F.lower(text).rlike(NEEDED), _said_words(F.concat_ws(f" {BREAK} ", whole, F.array_join(segments, f" {BREAK} "))))
    opening = F.concat(*[F.when(F.col("_words").rlike(f"^ (?:the )?{title} (?:{kind.lower()} )?version "), F.lit(kind)).otherwise(F.lit("")) for kind, title in GNU.items()])
    read = files.withColumn("_words", words).withColumn("_title", F.when(opening != "", opening))
    rows = materialise(read.select(*carried, F.coalesce(F.array_distinct(F.transform(segments, F.trim)), F.array().cast("array<string>")).alias("_said"), "_title",
                                    F.coalesce(F.when(F.col("_words").isNotNull(), _forms(F.col("_words"), F.col("_title"))), F.array().cast("array<string>")).alias("_found"),
                                    F.regexp_extract(path_col, r"^(.*)/[^/]*$", 1).alias("_dir"), F.col(path_col).startswith("/").alias("_rooted")), "licence-files")
    statements = rows.select(F.explode("_said").alias("statement")).distinct()
    scores = materialise(statement_scores(statements, templates, least), "statement-scores")

    told = rows.where((F.size("_said") > 0) | (F.size("_found") > 0)).select(F.col(path_col).alias("_path"), "_said", "_found", "_title").distinct()
    key = ["_path", "_said", "_found"]
    scored = told.withColumn("statement", F.explode("_said")).join(scores, "statement").where(_agrees(F.col("name"), F.col("_title")))
    formed = told.select(*key, F.lit(1.0).alias("score"), F.explode("_found").alias("name"))
    own = scored.select(*key, "score", "name").unionByName(formed).groupBy(*key).agg(
        F.max(F.struct("score", "name")).alias("_own"), F.array_sort(F.collect_set("name")).alias("_names"))
    own = materialise(own, "own-licences")

    named = own.where(F.col("_path").rlike(LICENCE_FILE))
    of_dir = (named.withColumn("_each", F.explode("_names")).groupBy(F.regexp_extract("_path", r"^(.*)/[^/]*$", 1).alias("_at"), F.col("_path").startswith("/").alias("_rooted"))
              .agg(F.max("_own")["name"].alias("name"), F.array_sort(F.collect_set("_each")).alias("names")))
    dirs = rows.where(F.col(path_col).isNotNull()).select("_dir", "_rooted").distinct()
    parts = F.split("_dir", "/")
    # The top of a relative tree is depth 0; an absolute one's is depth 1, as its first part is empty.
    depths = F.explode(F.sequence(F.when(F.col("_rooted"), 1).otherwise(0), F.size(parts)))
    above = dirs.select("_dir", "_rooted", depths.alias("depth")).select("_dir", "_rooted", "depth", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/").alias("_at"))
    nearest = (above.join(of_dir, ["_at", "_rooted"]).groupBy(F.col("_dir").alias("_nd"), F.col("_rooted").alias("_nr"))
               .agg(F.max(F.struct("depth", "_at", "name", "names")).alias("_near")))

    found = (rows.join(own.withColumnsRenamed({"_said": "_s", "_found": "_f"}), F.col(path_col).eqNullSafe(F.col("_path")) & (F.col("_said") == F.col("_s"))
                       & (F.col("_found") == F.col("_f")), "left")
             .join(nearest, F.col(path_col).isNotNull() & (F.col("_dir") == F.col("_nd")) & (F.col("_rooted") == F.col("_nr")), "left"))
    inherits = F.col("_own").isNull()
    told = found.select(*carried, F.col("_own.name").alias("own_licence"), F.col("_own.score").alias("own_score"),
                        F.coalesce("_own.name", "_near.name").alias("licence"), F.when(inherits, F.col("_near._at")).alias("inherited_from"),
                        F.coalesce("_names", F.array().cast("array<string>")).alias("own_licences"),
                        F.coalesce("_names", "_near.names", F.array().cast("array<string>")).alias("licences"))
    return named_back(told, {c: given for c, given in names.items() if given != text_col}, ADDED, ADDED)
