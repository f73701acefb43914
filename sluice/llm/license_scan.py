"""Licence scan by canonical digests.

Texts are brought to one form: copyright lines gone, lower case, punctuation and white space to single spaces,
equivalent spellings made one. A copyright line is one that starts with the word or sign and goes on with a sign, a
year (or its placeholder) or, capitalised, with a name to its end; a wrapped sentence that happens to go on with
"copyright notice" is text. The SHA-256 of the whole form is looked up among the digests of known licences, and so are
the lines of a text, each a text of its own. Known texts are a parameter; the defaults hold short licences and notices
as texts and long ones as digests of their published texts.

Whole texts are hash-joined to the known digests, which are broadcast while they were counted as few, so the scan reads
texts once and shuffles nothing. Lines look theirs up among up to MOST_LITERAL known digests in the expression itself;
beyond that they are joined too.

Defined results: a null or empty text, or one without a letter or digit, has the empty form's digest and no licence;
known texts of an empty form count for nothing; of known texts with the same form the first id counts; repeated rows
are repeated; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import small

#: Equivalent spellings, over lower-case words with single spaces between them (what becomes what).
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("favour", "favor"),
    ("https ", "http "),
    (" version ", " "),
    (" v ", " "),
)
_MARGIN = r"[ \t*#/;-]*"
#: Copyright lines in lower case; and lines of the word and a name, as they are written.
COPYRIGHT_LINE = r"(?:^|\n)" + _MARGIN + r"(?:(?:copyright|copr\.)[ \t:,]*(?:\(c\)|©|[0-9]{4}|[\[<{](?:yyyy|year))|\(c\)[ \t]*(?:copyright|[0-9]{4})|©)[^\n]*"
NAMED_LINE = r"(?:^|\n)(?:" + _MARGIN + r"Copyright[ \t]+(?:[A-Z][a-z0-9.&'-]*,?[ \t]*){2,}(?:\n|$))+"
#: The same for Java, which repeats a group by recursion unless it may never give a repetition back. It need not here: a
#: name begins with the only capital letter in it, and a line ends at the only place where it can.
_NAMED_LINE_JAVA = r"(?:^|\n)(?:" + _MARGIN + r"Copyright[ \t]+(?:[A-Z][a-z0-9.&'-]*+,?+[ \t]*+){2,}+(?:\n|$))++"
#: Known digests up to this many stand in the expression for lines as literals.
MOST_LITERAL = 2_000

_PERMISSION = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so{terms}

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_MIT_TERMS = """, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""
_PURPOSE = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{terms}

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_UNENCUMBERED = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
_SHORT = (
    ("MIT", _PERMISSION.format(terms=_MIT_TERMS), ("", "The MIT License", "MIT License", "The MIT License (MIT)")),
    ("MIT-0", _PERMISSION.format(terms="."), ("", "MIT No Attribution")),
    ("ISC", _PURPOSE.format(terms=", provided that the above copyright notice and this permission notice appear in all copies."), ("", "ISC License")),
    ("0BSD", _PURPOSE.format(terms="."), ("", "BSD Zero Clause License")),
    ("BSD-2-Clause", _BSD.format(third=""), ("", "All rights reserved.", "BSD 2-Clause License", "BSD 2-Clause License\n\nAll rights reserved.")),
    ("BSD-3-Clause", _BSD.format(third=_THIRD), ("", "All rights reserved.", "BSD 3-Clause License", "BSD 3-Clause License\n\nAll rights reserved.")),
    ("Unlicense", _UNENCUMBERED, ("",)),
)
#: Licence texts without their copyright lines, under each title, and one-line notices.
KNOWN = (
    *((i, f"{title}\n\n{text}" if title else text) for i, text, titles in _SHORT for title in titles),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("all-rights-reserved", "All rights reserved."),
)
#: Digests of the canonical forms of long licences as their stewards publish them, by file name there.
DIGESTS = (
    ("Apache-2.0", "56a561bcaf2d3e3099bc992836b55ea7a17a1c01c99abe64858b92b0f3134c6a"),
    ("Apache-2.0", "3ff2e363ee3915b0a6aad9d16dc7426463e0e39c32b591e51c42ecc13b98f47f"),
    ("Artistic-1.0-Perl", "9968c2c6a84e31b4004cec6494a1693ed698d0fb57d54ed6ee464f0228fe1cf2"),
    ("CC0-1.0", "faf752a00431e77a7cb10e16bd3d40575c05b0cd42d19910a32e2a35c449b53b"),
    ("GFDL-1.2", "7dcf014d80b01a3c1ada95790cbd4e267fe336215e97dbbf7f21a0cdd15aead0"),
    ("GFDL-1.3", "e8d291721d79f89f531ce09181d7ca00987c0ea22aa02cc9db053a971e0f17fa"),
    ("GPL-1.0", "310014c8ac015742451ad9c94a3fb85d1a424c97b342b67820012ca5375d7337"),
    ("GPL-2.0", "f250d8e9bdaceb4970c70578140b9dff2e55ae107797f66c5e8dc845635bfe60"),
    ("GPL-3.0", "5768470e0527f96eff21a39790958d8ea7c4a653aef1d2b073f9a10fcb321e30"),
    ("LGPL-2.0", "538f2b5bad6aab8f0ae7f23a9969aea626a4734c66e482e9b62407bb9b3fa3da"),
    ("LGPL-2.1", "bbc13d69f348b35c0daa0da1ad1c66027b6a4b581894be106fc5998eeb540913"),
    ("LGPL-3.0", "6b7235d3fb71e3e003c181b2c4040028d4a5fe17bb00b1f21e7bbf9582ca9de5"),
    ("MPL-1.1", "ac31357a807b96710a73041f16a3b3314806ac7f4c99827f589772eb65b50f5d"),
    ("MPL-2.0", "02d912b7f55fc2238dc6d20403ab4deab35451ff5dd4e7271ba2c41f49a551be"),
)


def _bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x worked out once."""
    return F.transform(F.array(x), f)[0]


def _copyright_gone(text: Column) -> Column:
    """Lower-case text; the patterns run only where their words are."""

    def named(x: Column) -> Column:
        return F.when(F.contains(x, F.lit("Copyright")), F.regexp_replace(x, _NAMED_LINE_JAVA, "\n")).otherwise(x)

    def signed(x: Column) -> Column:
        any_sign = reduce(or_, (F.contains(x, F.lit(sign)) for sign in ("copyright", "copr.", "(c)", "©")))
        return F.when(any_sign, F.regexp_replace(x, COPYRIGHT_LINE, "")).otherwise(x)

    return _bound(F.lower(_bound(F.coalesce(text, F.lit("")), named)), signed)


def _spelt(words: Column, spellings: tuple[tuple[str, str], ...]) -> Column:
    """One spelling, of words that have single spaces before, between and after them."""

    def replaced(old: str, new: str) -> Callable[[Column], Column]:
        return lambda x: F.when(F.contains(x, F.lit(old)), F.replace(x, F.lit(old), F.lit(new))).otherwise(x)

    for old, new in spellings:
        words = _bound(words, replaced(old, new))
    return words


def line_forms(text: Column) -> Column:
    """The forms of a text's lines that aren't empty, copyright lines gone."""
    plain = F.regexp_replace(F.replace(_copyright_gone(text), F.lit("&"), F.lit(" and ")), r"[^\p{L}\p{N}\n]+", " ")
    apart = F.replace(F.replace(F.concat(F.lit(" "), plain, F.lit(" ")), F.lit("\n"), F.lit(" \n ")), F.lit("  "), F.lit(" "))
    return F.filter(F.transform(F.split(_spelt(apart, SPELLINGS), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def whole_form(lines: Column) -> Column:
    """The form of the text of these lines; spellings of two words may go over a line's end."""
    return F.trim(_spelt(F.concat(F.lit(" "), F.array_join(lines, " "), F.lit(" ")), tuple(x for x in SPELLINGS if " " in x[0].strip())))


def canonical(text: Column) -> Column:
    """The one form of a text."""
    return whole_form(line_forms(text))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(KNOWN), "license_id string, text string")


def long_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DIGESTS), "license_id string, digest string")


def known_digests(known: DataFrame, digests: DataFrame | None = None) -> DataFrame:
    """known (a digest) and license_id of known texts and digests, one row for each digest but the empty form's."""
    k = known.select(digest(known["text"]).alias("known"), known["license_id"])
    if digests is not None:
        k = k.unionByName(digests.select(digests["digest"].alias("known"), digests["license_id"]))
    return k.filter((F.col("known") != F.sha2(F.lit(""), 256)) & F.col("license_id").isNotNull()).groupBy("known").agg(F.min("license_id").alias("license_id"))


def scanned(docs: DataFrame, known: DataFrame, digests: DataFrame | None = None, most_literal: int = MOST_LITERAL) -> DataFrame:
    """doc_id, digest, license_id (of the whole text, or null) and notices (ids of lines' licences, sorted, joined, or null)."""
    found = known_digests(known, digests)
    few = found.limit(most_literal + 1).collect()
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], line_forms(docs["text"]).alias("lines"))
    d = d.select("doc_id", "text", "lines", F.sha2(whole_form(F.col("lines")), 256).alias("digest"))
    lines = F.transform("lines", lambda x: F.sha2(x, 256))
    if not few:
        return d.select("doc_id", "digest", *(F.lit(None).cast("string").alias(c) for c in ("license_id", "notices")))
    found = small(found)
    whole = d.join(found, d["digest"] == found["known"], "left").drop("known")
    if len(few) <= most_literal:
        ids = F.create_map(*(F.lit(x) for r in few for x in r))
        every = [r["known"] for r in few]
        met = F.transform(F.filter(lines, lambda x: x.isin(every)), lambda x: F.element_at(ids, x))
        return whole.select("doc_id", "digest", "license_id", F.nullif(F.array_join(F.array_sort(F.array_distinct(met)), ","), F.lit("")).alias("notices"))
    # what lines hold depends on the text alone, so the text's own digest leads back to its rows
    key = F.sha2(F.coalesce("text", F.lit("")), 256)
    each = d.select(key.alias("__key"), F.explode(F.array_distinct(lines)).alias("d"))
    met = each.join(found, each["d"] == found["known"]).groupBy("__key").agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"))
    whole = whole.select("doc_id", "digest", "license_id", key.alias("__text"))
    return whole.join(met, F.col("__text") == F.col("__key"), "left").select("doc_id", "digest", "license_id", "notices")


def oracle(known: tuple[tuple[str, str], ...] = KNOWN, digests: tuple[tuple[str, str], ...] = DIGESTS) -> str:
    """The same in SQL for DuckDB."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def spelt(x: str, spellings: tuple[tuple[str, str], ...]) -> str:
        for old, new in spellings:
            x = f"replace({x}, {quoted(old)}, {quoted(new)})"
        return x

    def lines(x: str) -> str:
        gone = f"regexp_replace(lower(regexp_replace(coalesce({x}, ''), {quoted(NAMED_LINE)}, chr(10), 'g')), {quoted(COPYRIGHT_LINE)}, '', 'g')"
        plain = f"' ' || regexp_replace(replace({gone}, '&', ' and '), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g') || ' '"
        apart = f"replace(replace({plain}, chr(10), ' ' || chr(10) || ' '), '  ', ' ')"
        return f"list_filter(list_transform(string_split({spelt(apart, SPELLINGS)}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"

    def whole(x: str) -> str:
        two = tuple(s for s in SPELLINGS if " " in s[0].strip())
        return f"sha256(trim({spelt(f"' ' || array_to_string({x}, ' ') || ' '", two)}))"

    texts = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in known)
    long = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in digests)
    return f"""
with k as (select {whole("x")} as known, i from (select i, {lines("t")} as x from (values {texts}) k(i, t)) union all select d, i from (values {long}) k(i, d)),
known as (select known, min(i) as license_id from k where known <> sha256('') group by 1),
d as (select doc_id, text, {lines("text")} as x from documents),
lines as (select distinct text, sha256(l) as d from (select text, unnest(x) as l from d)),
met as (select text, string_agg(license_id, ',' order by license_id) as notices from (select distinct l.text, k.license_id from lines l join known k on l.d = k.known) group by text)
select d.doc_id, {whole("d.x")} as digest, k.license_id, m.notices
from d left join known k on {whole("d.x")} = k.known left join met m on d.text = m.text"""
