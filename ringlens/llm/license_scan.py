"""License scan: normalised units of a text against licence templates by Dice coefficient, in DataFrame functions only.

Units are the whole text, its paragraphs (between blank lines), its lines and windows of its words (for notices inside a longer line
or wrapped over several). Text is normalised to lower-case words of letters
and digits. The Dice coefficient of a unit and a template is 2 |A and B| / (|A| + |B|) over their sets of word bigrams.

Two exact bounds come first. A unit can only reach the threshold t with a template of b bigrams if it has between
t b / (2 - t) and (2 - t) b / t bigrams. And it then shares so many bigrams with the template that it must contain one of a few
of them, the template's signals: texts and units without any signal are not looked at further.

Templates of different licences can be alike, as two versions of one header are. So where a template reaches the threshold with another
licence's, a unit must also have a bigram that tells the two apart.

Windows begin and end with a bigram of the template, as others at an end only lower the coefficient, have at most the largest
size, and hold at least as many places of template bigrams as a match needs.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import only_columns

THRESHOLD = 0.8

# Notices of public licences.
TEMPLATES = {
    "All-Rights-Reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
               "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}


# Standard headers and telling paragraphs of public licence texts.
TEXTS = {
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:",
    ),
    "BSD-3-Clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission.",
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
        'documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software',
    ),
    "CC-BY-NC-4.0": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",),
    "CC-BY-SA-4.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication",
    ),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc.",
        "Licensed under the GNU General Public License v2",
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
        "Licensed under the GNU General Public License v3",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions:",
        "Licensed under the MIT License.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, "
        "or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and "
        "by any means.",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software.",
    ),
}


def all_templates() -> dict[str, tuple[str, ...]]:
    """Per licence its notice and its texts."""
    return {k: (*([TEMPLATES[k]] if k in TEMPLATES else []), *TEXTS.get(k, ())) for k in sorted({*TEMPLATES, *TEXTS})}


def _template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _template_bigrams(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Fewest and most bigrams of a unit that reaches the threshold with a template of ``n`` bigrams."""
    return math.ceil(threshold * n / (2 - threshold) - 1e-9), math.floor((2 - threshold) * n / threshold + 1e-9)


def least_common(n: int, threshold: float) -> int:
    """Fewest bigrams that a unit which reaches the threshold shares with a template of ``n`` bigrams."""
    return math.ceil(threshold * (n + size_bounds(n, threshold)[0]) / 2 - 1e-9)


def signals(bigrams: list[str], threshold: float) -> list[str]:
    """Bigrams of a template, one of which is in every unit that reaches the threshold with it: one more than such a unit
    can lack. The longest are taken, as they are rare."""
    least = least_common(len(bigrams), threshold)
    return sorted(bigrams, key=lambda b: (-len(b), b))[: len(bigrams) - least + 1]


def normalised(text: Column) -> Column:
    """Lower-case words of letters and digits, with a space before and after each."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def _constant(values: list[str]) -> Column:
    """A constant array of words or bigrams, which hold no line breaks."""
    return F.split(F.lit("\n".join(values)), "\n")


def _longest_words(found: list[str]) -> list[str]:
    """The longer word of each bigram."""
    return sorted({max(b.split(), key=lambda w: (len(w), w)) for b in found})


def bigrams(words: Column) -> Column:
    """The distinct pairs of neighbouring words."""
    return F.when(
        F.size(words) > 1,
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))),
    ).otherwise(F.array().cast("array<string>"))


def windows(words: Column, own: list[str], threshold: float) -> Column:
    """The normalised windows of the words that can reach the threshold with a template of the bigrams ``own``."""
    _, high = size_bounds(len(own), threshold)
    least = least_common(len(own), threshold)
    pairs = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.struct(i.alias("i"), F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)).alias("p")))
    places = F.transform(F.filter(pairs, lambda x: F.array_contains(_constant(own), x["p"])), lambda x: x["i"])

    def around(at: Column) -> Column:
        def from_place(k: Column) -> Column:  # k counts from 1, and so do the places in ``at``
            start = F.get(at, k - 1)
            ends = F.filter(F.slice(at, k + (least - 1), F.lit(high)), lambda e: e - start < high)
            return F.transform(ends, lambda e: F.concat(F.lit(" "), F.array_join(F.slice(words, start, e - start + 2), " "), F.lit(" ")))

        some = F.flatten(F.transform(F.sequence(F.lit(1), F.size(at) - (least - 1)), from_place))
        return F.when(F.size(at) >= least, some).otherwise(F.array().cast("array<string>"))

    bound = F.element_at(F.transform(F.array(places), around), 1)
    return F.when(F.size(words) > 1, bound).otherwise(F.array().cast("array<string>"))


def telling(forms: list[tuple[str, list[str]]], at: int, threshold: float) -> list[list[str]]:
    """What tells a template from those of other licences that it reaches the threshold with: its bigrams that they lack."""
    name, own = forms[at]
    out = []
    for other, theirs in forms:
        common = len(set(own) & set(theirs))
        if other != name and 2 * common >= threshold * (len(own) + len(theirs)):
            out.append(sorted(set(own) - set(theirs)))
    return out


def license_scan(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str | tuple[str, ...]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: doc_id, n_licenses, licenses, best_license, best_dice.

    ``templates`` has one or more texts per licence (default: :func:`all_templates`). ``licenses`` is an array of (license, dice, unit) by
    name: per matching licence its best coefficient and a unit that has it
    (the normalised words). The best licence has the largest coefficient, of equal ones the first name. Null and empty texts and texts without a
    match have no licences, a null best licence and 0. Repeated rows each have a row. A template that has no bigram of its own beside a like
    one of another licence never matches.
    """
    forms: list[tuple[str, list[str]]] = []
    for name, texts in sorted((templates or all_templates()).items()):
        for text in [texts] if isinstance(texts, str) else texts:
            pairs = _template_bigrams(_template_words(text))
            if not pairs:
                raise ValueError(f"template {name} has fewer than two words")
            forms.append((name, pairs))
    own_signs = [signals(own, threshold) for _, own in forms]
    signs = sorted({b for found in own_signs for b in found})
    tells = [telling(forms, at, threshold) for at in range(len(forms))]

    def hits(unit: Column, tried: range | list[int]) -> Column:
        # bound to a lambda's variable, the words are split once and not for every bigram
        pairs = F.element_at(F.transform(F.array(F.split(F.trim(unit), " ")), bigrams), 1)

        def against(p: Column) -> Column:
            size = F.size(p)
            found = []
            for at in tried:
                name, own = forms[at]
                low, high = size_bounds(len(own), threshold)
                fits = reduce(Column.__and__, [F.arrays_overlap(p, _constant(t)) if t else F.lit(False) for t in tells[at]], size.between(low, high))
                common = F.size(F.array_intersect(p, _constant(own)))
                dice = F.when(fits, 2.0 * common / (size + len(own))).otherwise(0.0)
                found.append(F.struct(F.lit(name).alias("license"), dice.alias("dice"), F.trim(unit).alias("unit")))
            return F.filter(F.array(*found), lambda m: m["dice"] >= threshold)

        return F.flatten(F.transform(F.array(pairs), against))

    docs = only_columns(documents, doc_id=id_col, text=text_col)
    text = F.coalesce("text", F.lit(""))
    nothing = F.array().cast("array<struct<license:string,dice:double,unit:string>>")
    some = F.arrays_overlap("pairs", _constant(signs))

    def in_units() -> Column:
        parts = F.concat(F.split(text, r"\n\s*\n"), F.split(text, r"\n"))
        units = F.array_distinct(F.concat(F.array(normalised(text)), F.transform(parts, normalised)))
        return F.flatten(F.transform(units, lambda u: hits(u, range(len(forms)))))

    def in_windows(at: int) -> Column:
        own = forms[at][1]
        spans = F.flatten(F.transform(F.array("words"), lambda words: windows(words, own, threshold)))
        return F.when(F.arrays_overlap("pairs", _constant(own_signs[at])), F.flatten(F.transform(F.array_distinct(spans), lambda u: hits(u, [at])))).otherwise(nothing)

    found = (
        docs.withColumn("words", F.split(F.trim(normalised(text)), " "))
        # most texts have no word of a signal, and of the others most have no signal
        .withColumn("pairs", F.when(F.arrays_overlap("words", _constant(_longest_words(signs))), bigrams(F.col("words"))).otherwise(F.array().cast("array<string>")))
        .select("doc_id", F.when(some, F.concat(in_units(), *[in_windows(at) for at in range(len(forms))])).otherwise(nothing).alias("hits"))
    )
    best = F.transform(
        F.array_distinct(F.array_sort(F.transform("hits", lambda m: m["license"]))),
        lambda name: F.array_max(F.transform(F.filter("hits", lambda m: m["license"] == name), lambda m: F.struct(m["dice"], name.alias("license"), m["unit"]))),
    )
    top = F.array_max(F.transform("licenses", lambda m: m["dice"]))
    return (
        found.select("doc_id", F.transform(best, lambda m: F.struct(m["license"], m["dice"], m["unit"])).alias("licenses"))
        .select(
            "doc_id", F.size("licenses").cast("long").alias("n_licenses"), "licenses",
            F.get(F.filter("licenses", lambda m: m["dice"] == top), F.lit(0))["license"].alias("best_license"),
            F.coalesce(top, F.lit(0.0)).alias("best_dice"),
        )
    )
