"""License scan by canonical digests.

A text is put into canonical form (lower case, copyright lines dropped,
punctuation to spaces, equivalent spellings unified, one space between words)
and its SHA-256 is looked up among the digests of known licence texts and
notices by a hash join: whole texts, and runs of whole lines.  No text is
compared with another.  Long licences are known by digest alone; full texts
count with and without their titles.

A run of lines can be a known form only if it begins with the form's first two
words and has as many words.  Texts in which no line begins so are done after
one regular expression; the lines of the others are numbered by the words
before them, a line that begins a form is joined with the line that ends as
many words later, and the digest of what lies between decides.

Defined results: null and empty texts have an empty canonical form, no digest
and no licence; texts of punctuation or copyright lines alone likewise;
repeated rows give repeated results; two known texts with one canonical form
count as the one first by name; an empty table gives no rows; other columns
are ignored.  Lines are the parts between line feeds; a notice may be broken
over any lines.  A form within a longer one that is found too counts as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeviews.llm.common import join_small, let, save, table

# Licence names with their texts or notices.
KNOWN = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation '
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished "
        "to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
        'or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT "
        "OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        'that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR '
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License."],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not "
        "be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in "
        "the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must "
        "not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ],
    "0BSD": [
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS '
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY '
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
        "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
}

# The two shorter BSD licences, by their parts.
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. ")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
              "this software without specific prior written permission. ")
_BSD_END = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
            "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
            "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
            "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
            "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
            "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
KNOWN["BSD-2-Clause"] = ["Licensed under the BSD 2-Clause License.", "Released under the BSD 2-Clause License.", _BSD + _BSD_END]
KNOWN["BSD-3-Clause"] += [_BSD + _BSD_NAMES + _BSD_END, (_BSD + _BSD_NAMES + _BSD_END).replace("1. R", "* R").replace("2. R", "* R").replace("3. N", "* N")]

# Titles that a full text of a licence may have, besides none.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License"],
    "Zlib": ["zlib License", "The zlib License"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "BSD License", 'BSD 3-Clause "New" or "Revised" License'],
}
FULL = 60  # words of a text that titles may stand before, at least

# Long licences by (digest of the canonical form, its words, its first two words): whole, without lines of the heading, without the appendix.
KNOWN_DIGESTS = {
    "Apache-2.0": [
        ("ef36af97727268b60fb709836c24580bed9887f649dba6f0fd9ef4b18232fd25", 1607, "apache license"),
        ("e209bb39c90fd25042b31f2ccdd091ac83647ccdb1b89a7bc5d8a7cc31a4cdcb", 1605, "version 2"),
        ("55ee3da558ea98c70eacf71c77d4b7ea407aeb232dbdd49def513b7149f58464", 1600, "http www"),
        ("deb545743ba2ee484c58a92230d43f8b6a39185ee86d9256ffdfefdb82b1dc6d", 1595, "terms and"),
        ("119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40", 1430, "apache license"),
    ],
    "Artistic-1.0-Perl": [
        ("08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702", 983, "the artistic"),
        ("4eaaa9e33aeef0af0ff83ab5edac0ad421a1da9cc861c564630460107b4b772c", 980, "preamble the"),
    ],
    "CC0-1.0": [
        ("cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e", 1087, "creative commons"),
        ("e91800afc6c48672fba71b29313951a2d91bd4f1e1d61ee386402d621dba7a0a", 1083, "cc0 1"),
        ("13a06619caac563ef75dbb6b16c7b185cd8a7255a4c7134aecf15ed03eeb0b9e", 1079, "creative commons"),
    ],
    "GFDL-1.2": [
        ("94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60", 3315, "gnu free"),
        ("b8fc1476fcb02a8c859046708b4843944af8ef9ae2f634b9f46b5a633388f9f3", 3311, "version 1"),
        ("46df66eb30fadb738a42b19ccce2f18a583866e5837bccc790b4acff41ba12da", 3306, "51 franklin"),
    ],
    "GFDL-1.3": [
        ("a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826", 3732, "gnu free"),
        ("e907f46bdc7f3e8e6160d770fd1642b01fb33d2f98ef7b09c8988fbe26f79fae", 3728, "version 1"),
        ("3c426fbfcdf22792d87bb85fe1538455be3c49904a6d4c0f754f86b16154c8bf", 3722, "http fsf"),
    ],
    "GPL-1.0": [
        ("8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224", 2067, "gnu general"),
        ("9132a605811c9f9a51621da0e0708f46e408e3507a3c1a9d16a5f48291082b8c", 2063, "version 1"),
        ("4a0d740eb4453dafe0e6d04e2d2e4f04c7c85bc1fbef96bc056ea93e7c1c36bc", 2059, "51 franklin"),
        ("6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc", 1641, "gnu general"),
    ],
    "GPL-2.0": [
        ("efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821", 2975, "gnu general"),
        ("29507662ad31f55a5ac02f26a5d8cca21add440b2dff4a9ce97e458a0ca43f7f", 2971, "version 2"),
        ("4767c85efb312bbe244abef9b752be38b44e810f05ed9bfae182caf068d13fd3", 2967, "51 franklin"),
        ("e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34", 2504, "gnu general"),
    ],
    "GPL-3.0": [
        ("eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a", 5684, "gnu general"),
        ("bf9e206799496404ec781ceaf777966308e875445239b2a25248b6a0f817844d", 5680, "version 3"),
        ("04a10e711844fe517f9ffba9481db6a825f2f268002c49184ecb8c942911bff3", 5675, "everyone is"),
        ("ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636", 5241, "gnu general"),
    ],
    "LGPL-2.0": [
        ("61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908", 4200, "gnu library"),
        ("f17ebefdba4ae01060494f3396c1bc854578b6eaafaa6fe8abcf7a94e7fc2a6e", 4195, "version 2"),
        ("aa06ce7f6e464e73e65ec0efa0bc575ef5bb7059ae0137ab610c2e57b32ca95c", 4191, "51 franklin"),
        ("504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260", 3865, "gnu library"),
    ],
    "LGPL-2.1": [
        ("4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891", 4401, "gnu lesser"),
        ("50866b22e296e073a398813dc84c4c9dec94ed1ee7d617c063eb6851a562b9d4", 4396, "version 2"),
        ("e94f6c31379c2076fae91e236d6000ea55d918637fc8f30749aa0fe22a265c7f", 4391, "51 franklin"),
        ("48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4", 4065, "gnu lesser"),
    ],
    "LGPL-3.0": [
        ("aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be", 1231, "gnu lesser"),
        ("e1c7b25e9116bcad127297bbfb82e6a89822822ba6bfa3af9eae995aad877765", 1226, "version 3"),
        ("13980739d6423be0921994d8ce3ce547437735b0e6733161f70b19c962f194b7", 1221, "everyone is"),
    ],
    "MPL-1.1": [
        ("cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6", 3786, "mozilla public"),
        ("0660d1922f9d3acf19bf9040a5c9636739265bae8625a5643a955e9e5283dec1", 3783, "version 1"),
        ("34386b9a926117ec1b973ef1b1ef8fba50be254811addc9f9659bcc5d5a096bf", 3780, "1 definitions"),
    ],
    "MPL-2.0": [
        ("f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a", 2426, "mozilla public"),
        ("c0f855aacb6ac1c86bcdd1334db61014d14898798ae14888fea5446cbb9d32e3", 2420, "1 definitions"),
    ],
}

# Spellings that count as equal, other form to the form kept.
EQUIVALENT = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense", "merchantability": "merchantability",
    "acknowledgement": "acknowledgment", "analogue": "analog", "authorisation": "authorization", "authorised": "authorized",
    "calibre": "caliber", "cancelled": "canceled", "catalogue": "catalog", "centre": "center", "favour": "favor", "favourite": "favorite",
    "fulfil": "fulfill", "fulfilment": "fulfillment", "judgement": "judgment", "labour": "labor", "modelling": "modeling",
    "noncommercial": "noncommercial", "organisation": "organization", "organise": "organize", "practise": "practice",
    "programme": "program", "realise": "realize", "recognise": "recognize", "sub license": "sublicense", "non infringement": "noninfringement",
    "whilst": "while", "wilful": "willful", "copyright owner": "copyright holder", "copyright owners": "copyright holders", "per cent": "percent",
    "https": "http",
}
_CHANGED = {k: v for k, v in EQUIVALENT.items() if k != v}
_MERGED = sorted(a for a, b in _CHANGED.items() if " " in a and " " not in b)  # two words that count as one, also over a line's end

COPYRIGHT_LINE = r"(?im)^[^A-Za-z0-9\n]*(?:copyright\b[^\n]*(?:\d{4}|\(c\)|©)|\(c\)[^\n]*\d{4}|©|all rights reserved)[^\n]*$"


HAS_COPYRIGHT = r"(?i)copyright|\(c\)|©|all rights reserved"
GAP = r"[^\p{L}\p{N}]+"


def _respelt(form: Column) -> Column:
    out = form
    for a, b in _CHANGED.items():
        out = F.regexp_replace(out, rf"\b{a}\b", b)
    return F.when(form.rlike(r"\b(" + "|".join(_CHANGED) + r")\b"), out).otherwise(form)


def canonical(text: Column) -> Column:
    """Canonical form of a text."""
    kept = let(text, lambda t: F.when(t.rlike(HAS_COPYRIGHT), F.regexp_replace(t, COPYRIGHT_LINE, " ")).otherwise(t))
    return let(F.trim(F.regexp_replace(F.lower(kept), r"[^\p{L}\p{N}]+", " ")), _respelt)


def digest(text: Column) -> Column:
    return let(canonical(F.coalesce(text, F.lit(""))), lambda form: F.when(form != "", F.sha2(form, 256)))


def known_texts(known: dict[str, list[str]] = KNOWN) -> list[tuple[str, str]]:
    """(licence, text): all texts, the full ones with each of their titles too."""
    return [(name, title + x) for name, texts in known.items() for x in texts
            for title in ["", *(f"{t}\n" for t in TITLES.get(name, []) if len(x.split()) >= FULL)]]


def known_digests(spark: SparkSession, known: dict[str, list[str]] = KNOWN, digests: dict[str, list[tuple]] = KNOWN_DIGESTS) -> DataFrame:
    """(digest, license, n_words, prefix), one row per digest; the prefix is the canonical form's first two words."""
    words = F.split(canonical(F.col("body")), " ")
    texts = spark.createDataFrame(known_texts(known), "license string, body string").select(
        digest(F.col("body")).alias("digest"), "license", F.size(words).alias("n_words"), F.array_join(F.slice(words, 1, 2), " ").alias("prefix"))
    long = spark.createDataFrame([(d, name, n, p) for name, listed in digests.items() for d, n, p in listed], "digest string, license string, n_words int, prefix string")
    return (texts.unionByName(long).filter("digest IS NOT NULL").groupBy("digest")
            .agg(F.min("license").alias("license"), F.min("n_words").alias("n_words"), F.min("prefix").alias("prefix")))


def _may_begin(prefixes: DataFrame) -> str:
    """A regular expression for texts of which some line begins with one of the prefixes, before or after respelling."""
    spelt = {}
    for a, b in _CHANGED.items():
        spelt.setdefault(b.split(" ")[0], set()).add(a.split(" ")[0])

    def word(w: str) -> str:
        return "(?:" + "|".join(sorted({w, *spelt.get(w, ())})) + ")"

    # A row per two words that begin a licence: a reference list.
    begun = sorted(GAP.join(map(word, r["prefix"].split(" "))) for r in prefixes.select("prefix").distinct().collect())
    return r"(?im)^[^\p{L}\p{N}\n]*(?:" + "|".join(begun) + r")(?![\p{L}\p{N}])" if begun else "(?!)"


def runs_of_lines(texts: DataFrame, known: DataFrame) -> DataFrame:
    """(rid, first_line, last_line, license): runs of lines that are known forms; ``texts`` has rid and lines."""
    lines = texts.select("rid", F.posexplode("lines").alias("place", "line")).select("rid", "place", canonical(F.col("line")).alias("form")).filter("form <> ''")
    in_text = Window.partitionBy("rid").orderBy("place")
    # Lines of one text, by the number of words up to their end.
    ends = F.concat_ws(" ", F.lag(F.element_at(F.split("form", " "), -1)).over(in_text), F.element_at(F.split("form", " "), 1))
    placed = (lines.withColumn("n", F.size(F.split("form", " ")) - ends.isin(_MERGED).cast("int")).withColumn("until", F.sum("n").over(in_text))
              .withColumn("two", F.array_join(F.slice(F.split(F.concat_ws(" ", "form", F.lead("form").over(in_text)), " "), 1, 2), " ")))
    placed = save(placed.select("rid", "place", "until", (F.col("until") - F.col("n")).alias("before"), "two"), "license-lines")
    starts = placed.alias("l").join(known.alias("k"), F.col("l.two") == F.col("k.prefix")).select(
        "l.rid", F.col("l.place").alias("first_line"), (F.col("l.before") + F.col("k.n_words")).alias("until"), "k.digest", "k.license")
    pairs = starts.join(placed.select("rid", "until", F.col("place").alias("last_line")), ["rid", "until"])
    between = F.array_join(F.slice("lines", F.col("first_line") + 1, F.col("last_line") - F.col("first_line") + 1), "\n")
    return pairs.join(texts, "rid").filter(digest(between) == F.col("digest")).select("rid", "first_line", "last_line", "license")


def scan(docs: DataFrame, known: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, license, line_licenses, n_notices), one row per document.

    ``license`` is the licence that the whole text is, ``line_licenses`` the
    sorted distinct licences, comma-joined, of its runs of lines, of which there
    are ``n_notices``.
    """
    spark = docs.sparkSession
    known = save(known if known is not None else known_digests(spark), "license-digests")
    begins = F.coalesce(F.col(text).rlike(_may_begin(known)), F.lit(False))
    read = save(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("digest"),
                            F.when(begins, F.split(F.col(text), "\n")).alias("lines")), "license-texts")
    found = runs_of_lines(read.filter("lines IS NOT NULL").select("rid", "lines"), known)
    notices = found.groupBy("rid").agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("line_licenses"), F.count(F.lit(1)).alias("n_notices"))
    whole = join_small(read.select("rid", "doc_id", "digest").alias("d"), known.alias("k"), F.col("d.digest") == F.col("k.digest"))
    return (whole.select("d.rid", "d.doc_id", "d.digest", "k.license").join(notices, "rid", "left")
            .select("doc_id", "digest", "license", F.coalesce("line_licenses", F.lit("")).alias("line_licenses"), F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices")))


def op10_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    out = f"trim(regexp_replace(lower(regexp_replace({text}, {_sql_text(COPYRIGHT_LINE)}, ' ', 'g')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    for a, b in _CHANGED.items():
        out = f"regexp_replace({out}, '\\b{a}\\b', '{b}', 'g')"
    return out


def op10_sql() -> str:
    texts = ", ".join(f"({_sql_text(n)}, {_sql_text(x)})" for n, x in known_texts())
    digests = ", ".join(f"('{d}', '{name}', {n}, '{p}')" for name, listed in KNOWN_DIGESTS.items() for d, n, p in listed)
    words = "string_split({}, ' ')"
    return f"""
WITH forms AS (SELECT license, {_sql_canonical('body')} AS form FROM (VALUES {texts}) t(license, body)),
known AS (
  SELECT digest, min(license) AS license, min(n) AS n, min(prefix) AS prefix FROM (
    SELECT sha256(form) AS digest, license, len({words.format('form')}) AS n, array_to_string({words.format('form')}[1:2], ' ') AS prefix FROM forms
    UNION ALL SELECT * FROM (VALUES {digests}) t(digest, license, n, prefix)) GROUP BY 1),
docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents),
whole AS (SELECT rid, doc_id, {_sql_canonical('body')} AS form FROM docs),
lines AS (
  SELECT rid, place, {words.format('form')} AS words FROM (
    SELECT rid, place, {_sql_canonical('x')} AS form FROM (SELECT rid, unnest(all_lines) AS x, generate_subscripts(all_lines, 1) AS place FROM docs)) WHERE form <> ''),
counted AS (
  SELECT *, len(words) - CAST(coalesce(lag(words[-1]) OVER w || ' ' || words[1] IN ({', '.join(map(_sql_text, _MERGED))}), false) AS INT) AS n,
    array_to_string((words || coalesce(lead(words) OVER w, []))[1:2], ' ') AS two FROM lines WINDOW w AS (PARTITION BY rid ORDER BY place)),
placed AS (SELECT rid, place, two, sum(n) OVER w AS until, sum(n) OVER w - n AS before FROM counted WINDOW w AS (PARTITION BY rid ORDER BY place)),
notices AS (
  SELECT s.rid, k.license FROM placed s JOIN known k ON s.two = k.prefix JOIN placed e ON e.rid = s.rid AND e.until = s.before + k.n JOIN docs d ON d.rid = s.rid
  WHERE sha256({_sql_canonical("array_to_string(d.all_lines[s.place:e.place], chr(10))")}) = k.digest),
per_doc AS (SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS names, count(*) AS n FROM notices GROUP BY rid)
SELECT doc_id, CASE WHEN form <> '' THEN sha256(form) END AS digest, k.license, coalesce(names, '') AS line_licenses, coalesce(p.n, 0)::BIGINT AS n_notices
FROM whole w LEFT JOIN per_doc p USING (rid) LEFT JOIN known k ON form <> '' AND k.digest = sha256(form)
"""
