"""License scans by canonical digest lookup.

A text's canonical form has lower case, no copyright lines, one space for every run of characters other than a-z and 0-9,
and one spelling of words that are spelt two ways. The SHA-256 of the form of the entire text is joined by hash with
those of known licences: a table of constants, KNOWN and WHOLE, so it is broadcast and no text moves. Lines are looked up
in the notices among them as an array inside their row, without rows of their own. Expressions only, all in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that count as one.
SPELLINGS = (("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("organisation", "organization"), ("authorised", "authorized"), ("favour", "favor"), ("non infringement", "noninfringement"), ("merchantibility", "merchantability"), ("acknowledgement", "acknowledgment"), ("whilst", "while"))

#: Texts of known licences and of the notices that stand for them.
KNOWN = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)

#: Canonical digests of entire licence texts as their stewards publish them, with and without a title line, a
#: closing line or an appendix on how to apply them.
WHOLE = (
    ("Apache-2.0", "1503ed7ce6c2188ed269646562607a76b5c74bff588f36b20862ee3af525f3ea"),
    ("Apache-2.0", "f9138026e58bdb767e6c6e974637ff9aacbaedf2695e30fef144e5d7d84448ff"),
    ("Apache-2.0", "6fb8411669deea22294b6190fad00b8e39899d0b7b6c5cf97a3b15b47e129c38"),
    ("Apache-2.0", "129294488cadbe2acee6d28d177d42a3acc4e0cfb69893738a3ca4965b35cdf9"),
    ("Artistic-1.0-Perl", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("BSD-2-Clause", "7be8178e4e9d0dea6ff4b04bd52bd086d7ea8386a5a6e09760df916bae5d42d2"),
    ("BSD-2-Clause", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("BSD-3-Clause", "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af"),
    ("BSD-3-Clause", "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15"),
    ("BSD-3-Clause", "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
    ("GFDL-1.2", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.3", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GPL-1.0", "8a4692e318e41e8d96d4610f021d16f03ff4485322f3d81c00d2621fdda7b2b1"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-2.0", "0248b317bc123a7424b6ff9799b9786ffde75241881994270612a604d03836cc"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0", "bec7867177d4b314be0fbe57d8b3612f5685e513e44d549a66dab0f7451e5af1"),
    ("GPL-3.0", "c12290e729cf5c76615f2090788703cf9e2f654a0abf9786258c53e41ea0c090"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0", "65df5e31324b0a43e48ca90288edf6406229b66f2dd0ebdea2b8db555625890a"),
    ("GPL-3.0", "776b0c1d471f51209ebaefc760759913e83edc9e6cd27f658488cdca2225c7ea"),
    ("ISC", "280d76b420aeff51730e96577a2466120c91213f03dd50d60107078c498c5b29"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0", "0e3c184176a70698802350b8f697a92e908601a66f8f622e8d4c08c9e90e0a8f"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MIT", "0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c"),
    ("MIT", "35a446201226de6b27cfb7106d0f6c697f63bfeac2913dcf89024911e66ef164"),
    ("MIT", "6c833965e9ca4cf8095655005226f24fe8bf7b1605dbe513204837a7371fa127"),
    ("MIT", "6ad3654379e72bbdf8478d5c90fb1e2525aba033fbe675e0ef2248aac67c0f6f"),
    ("MPL-1.1", "27d164b52dfaff4b5a631cd4eebfbb7683fe882e3057f2f2e01d54692688d985"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
)

COPYRIGHT = r"(^|\n)[^\n]*(copyright[ \t]+\(c\)|copyright[ \t]+©|copyright[ \t]+[0-9]|\(c\)[ \t]+[0-9]|©|all[ \t]+rights[ \t]+reserved)[^\n]*"


def canonical(text: Column) -> Column:
    form = F.regexp_replace(F.lower(text), COPYRIGHT, "\n")
    form = F.concat(F.lit(" "), F.regexp_replace(form, "[^a-z0-9]+", " "), F.lit(" "))
    for said, other in SPELLINGS:
        form = F.replace(form, F.lit(f" {said} "), F.lit(f" {other} "))
    return F.trim(form)


def canonical_sql(text: str) -> str:
    """The same in DuckDB's SQL."""
    form = f"' ' || regexp_replace(regexp_replace(lower({text}), '{COPYRIGHT}', chr(10), 'g'), '[^a-z0-9]+', ' ', 'g') || ' '"
    for said, other in SPELLINGS:
        form = f"replace({form}, ' {said} ', ' {other} ')"
    return f"trim({form})"


def known(spark: SparkSession, texts: tuple = KNOWN) -> DataFrame:
    """(form, license, digest), each form once."""
    rows = spark.createDataFrame(list(texts), "license string, said string")
    return rows.select("license", canonical(F.col("said")).alias("form")).groupBy("form").agg(F.min("license").alias("license")).withColumn("digest", F.sha2("form", 256))


def needed(forms: list[str]) -> str:
    """A pattern that the lower-case text of each of these forms must match: a few words, in all their spellings."""
    left, words = set(forms), sorted({w for f in forms for w in f.split()})
    patterns = []
    while left:
        best = max(words, key=lambda w: (sum(w in f for f in left), len(w)))
        left = {f for f in left if best not in f}
        patterns += [best, *(said.replace(" ", "[^a-z0-9]+") for said, other in SPELLINGS if best in other)]
    return "|".join(dict.fromkeys(patterns)) or "(?!)"


def scan(docs: DataFrame, *, id: str = "doc_id", text: str = "text", texts: tuple = KNOWN, digests: tuple = WHOLE) -> DataFrame:
    """id, digest, license, n_notices, notices for every row of docs.

    digest is that of the entire canonical text; license is what it is known as, or null: the texts of `texts`, and
    `digests`, pairs of a name and a canonical digest. n_notices counts the lines whose entire canonical form is one of
    `texts`, notices names their licences in order of the alphabet, joined by commas (empty: none). A null text counts as
    empty; empty forms are never known.
    """
    spark = docs.sparkSession
    rows = known(spark, texts).where("form <> ''").collect()  # the constants
    found = {r["digest"]: r["license"] for r in rows}
    names = F.create_map(*[F.lit(x) for pair in sorted(found.items()) for x in pair])
    table = spark.createDataFrame(sorted((dict((d, n) for n, d in reversed(digests)) | found).items()), "known_digest string, license string")
    body = F.coalesce(F.col(text), F.lit(""))
    # Lines without any word that a known text must have are not digested; they can't be equal to one.
    lines = F.filter(F.split(body, "\n"), lambda x: F.lower(x).rlike(needed([r["form"] for r in rows])))
    marks = F.transform(lines, lambda x: F.sha2(canonical(x), 256))
    marked = docs.select(F.col(id), F.sha2(canonical(body), 256).alias("digest"), F.filter(F.transform(marks, lambda d: F.try_element_at(names, d)), lambda x: x.isNotNull()).alias("hits"))
    joined = marked.join(F.broadcast(table), F.col("digest") == F.col("known_digest"), "left")
    return joined.select(F.col(id), "digest", "license", F.size("hits").cast("long").alias("n_notices"), F.array_join(F.array_sort(F.array_distinct("hits")), ",").alias("notices"))


def oracle() -> str:
    """scan() of documents in DuckDB's SQL."""
    rows = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in KNOWN)
    digests = ", ".join(f"('{n}', '{d}')" for n, d in WHOLE)
    return f"""with said(license, said) as (values {rows}), digests(license, digest) as (values {digests}),
 known as (select form, min(license) license from (select license, {canonical_sql("said")} form from said) where form <> '' group by form),
 every as (select sha256(form) digest, license from known union select digest, license from digests),
 whole as (select doc_id, sha256({canonical_sql("coalesce(text, '')")}) digest from documents),
 lines as (select doc_id, {canonical_sql("line")} form from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line from documents)),
 hits as (select doc_id, count(*) n, string_agg(distinct license, ',' order by license) notices from lines join known using (form) group by doc_id)
 select doc_id, digest, license, coalesce(n, 0) n_notices, coalesce(notices, '') notices from whole left join every using (digest) left join hits using (doc_id)"""
