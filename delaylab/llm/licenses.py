"""Licence scan by canonical digests, in DataFrame operations only.

Texts are normalised (case, punctuation, copyright lines, equivalent spellings), and the digest
of a whole normalised text is looked up among the digests of known licences. The same look-up is
made for each line, since a licence notice is commonly one line of a longer document.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators._plan import MAX_BROADCAST_BYTES, measured_bytes
from ._common import cut, lower_ascii, with_text_key

# Public licence texts and notices with their short identifiers.
KNOWN = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("proprietary", "All rights reserved."),
]
# Files of ``known`` with whole licences as they are distributed.
FILES = [("Apache-2.0", "Apache-2.0"), ("Artistic-1.0-Perl", "Artistic"), ("BSD-3-Clause", "BSD"),
         ("CC0-1.0", "CC0-1.0"), ("GFDL-1.2", "GFDL-1.2"), ("GFDL-1.3", "GFDL-1.3"),
         ("GPL-1.0", "GPL-1"), ("GPL-2.0", "GPL-2"), ("GPL-3.0", "GPL-3"), ("LGPL-2.0", "LGPL-2"),
         ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3.0", "LGPL-3"), ("MPL-1.1", "MPL-1.1"),
         ("MPL-2.0", "MPL-2.0")]
# Fixed value: the line after which a licence only says how to apply it.
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
# Titles that distributed files of the short licences begin with.
TITLES = {"MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
          "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
          "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "BSD 0-Clause License"],
          "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License",
                           "BSD 2-Clause \"Simplified\" License", "Simplified BSD License"],
          "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License",
                           "BSD 3-Clause \"New\" or \"Revised\" License"],
          "Zlib": ["zlib License", "The zlib License", "The zlib/libpng License"]}


def _distributed() -> list[tuple[str, str]]:
    """The short licences with their titles, a separate line of reserved rights and clauses
    without numbers, and the files with and without what follows their terms."""
    whole = [x for x in KNOWN if "\n" in x[1]]
    bsd = dict(whole)["BSD-2-Clause"]
    third = ("3. Neither the name of the copyright holder nor the names of its contributors may be "
             "used to endorse or promote products derived from this software without specific "
             "prior written permission.\n")
    whole.append(("BSD-3-Clause", bsd.replace("THIS SOFTWARE IS", third + "THIS SOFTWARE IS")))
    found = []
    for license_id, text in whole:
        plain = "\n".join(x[3:] if x[:1].isdigit() else x for x in text.split("\n"))
        found += [(license_id, "\n".join([*title, *rights, body]))
                  for title in ([], *[[x] for x in TITLES[license_id]])
                  for rights in ([], ["All rights reserved."])
                  for body in dict.fromkeys([text, plain])]
    for license_id, name in FILES:
        text = (Path(__file__).parent / "known" / f"{name}.txt").read_text(encoding="utf-8")
        found.append((license_id, text))
        if END_OF_TERMS in text:
            terms = text[:text.index(END_OF_TERMS)]
            found += [(license_id, terms), (license_id, terms + END_OF_TERMS)]
    return [x for x in found if x not in KNOWN]


KNOWN += _distributed()
# Spellings that licence matching treats as equal (variant, canonical).
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("calibre", "caliber"), ("cancelled", "canceled"), ("capitalisation", "capitalization"),
    ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("copyright owner", "copyright holder"), ("emphasised", "emphasized"),
    ("favour", "favor"), ("fulfilment", "fulfillment"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"),
    ("licence", "license"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("non commercial", "noncommercial"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("per cent", "percent"),
    ("practise", "practice"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("signalling", "signaling"), ("sub license", "sublicense"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
    ("https", "http"),
]
# Fixed value: a line that opens with a copyright claim naming a year, holder or symbol.
COPYRIGHT_LINE = r"(?m)^[^\n0-9a-z©]*(copyright +(\(c\)|©|[0-9]{4})|\(c\) +(copyright|[0-9]{4})|©)[^\n]*$"
# Fixed value: ASCII punctuation and white space but the line feed, no-break space, the copyright
# sign, dashes, typographic quotes, the bullet and the byte order mark.
BREAKS = (r"[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F\x{A0}\x{A9}\x{2010}-\x{2015}"
          r"\x{2018}-\x{201F}\x{2022}\x{FEFF}]+")


def canonical_lines(text: Column) -> Column:
    """Normalised lines of a text, without empty ones; an empty array for NULL."""
    low = lower_ascii(text)
    claims = F.when(F.contains(low, F.lit("copyright")) | F.contains(low, F.lit("(c)"))
                    | F.contains(low, F.lit("©")),
                    F.regexp_replace(low, COPYRIGHT_LINE, "")).otherwise(low)
    plain = F.regexp_replace(claims, BREAKS, " ")
    for variant, canonical in SPELLINGS:
        plain = F.replace(plain, F.lit(variant), F.lit(canonical))
    lines = F.split(plain, "\n")
    return F.coalesce(F.array_remove(F.transform(lines, lambda x: F.trim(x)), ""),
                      F.array().cast("array<string>"))


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def known_licenses(spark: SparkSession, extra: DataFrame | None = None) -> DataFrame:
    """(digest, license_id): digests of the known texts, and of ``extra(license_id, text)``."""
    table = spark.createDataFrame(KNOWN, "license_id string, text string")
    if extra is not None:
        table = table.unionByName(extra.select("license_id", "text"))
    body = F.concat_ws(" ", canonical_lines(F.col("text")))
    return (table.select(digest(body).alias("digest"), "license_id").where(F.length(body) > 0)
            .groupBy("digest").agg(F.min("license_id").alias("license_id")))


def scan_licenses(docs: DataFrame, extra: DataFrame | None = None, id_col: str = "doc_id",
                  text_col: str = "text",
                  max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """doc_id, text_digest, license_id, n_notices, notice_ids: one row per row of ``docs``.

    text_digest is the digest of the whole normalised text, license_id the licence whose whole
    text it is (NULL if none); n_notices counts the lines that are a known text by themselves
    and notice_ids lists their licences, distinct and sorted, comma-joined. NULL, empty and
    punctuation-only texts have the digest of the empty text and match nothing; of identifiers
    with one canonical text the smallest is reported; repeated rows are repeated in the result;
    an empty table gives an empty result; other columns are not read.
    """
    known = cut(known_licenses(docs.sparkSession, extra))
    if measured_bytes(known) <= max_broadcast_bytes:
        known = F.broadcast(known)
    lines = (with_text_key(docs, id_col, text_col)
             .select("_id", "_key", canonical_lines(F.col("_text")).alias("lines")))
    whole = F.array(F.struct(F.lit(True).alias("whole"),
                             digest(F.concat_ws(" ", "lines")).alias("digest")))
    parts = F.transform("lines", lambda x: F.struct(F.lit(False).alias("whole"),
                                                    digest(x).alias("digest")))
    found = (lines.select("_id", "_key", F.explode(F.concat(whole, parts)).alias("part"))
             .select("_id", "_key", "part.whole", "part.digest").join(known, "digest", "left")
             .where("whole or license_id is not null"))
    text = F.when(F.col("whole"), F.col("digest"))
    license_id = F.when(F.col("whole"), F.col("license_id"))
    notice = F.when(~F.col("whole"), F.col("license_id"))
    folded = found.groupBy("_id", "_key").agg(
        F.max(text).alias("text_digest"), F.max(license_id).alias("license_id"),
        F.count(notice).alias("n"), F.collect_set(notice).alias("ids"),
        F.count(text).alias("rows"))
    return folded.select(
        F.col("_id").alias("doc_id"), "text_digest", "license_id",
        F.expr("n div rows").alias("n_notices"),
        F.concat_ws(",", F.sort_array("ids")).alias("notice_ids"),
        F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("_copy")).drop("_copy")
