"""URL expressions: keys of job addresses."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rules of the job key; the first that matches anywhere wins, and
# its group (the whole match where it has none) is the key.
JOB_KEY_RULES = (
    r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    r"/jobs?/(\d{7,})",
    r"/(\d{15,})",
    r"/jobs/(\d{4,})/job",
    r"/jobs/(\d{7,})/",
    r"/(\d{8,})$",
    r"/(JR\d+)",
    r"/(R-\d+)",
    r"/(REQ[-_][\w]+)",
    r"search/(\d{10,})",
)
#: Shorter keys match nothing.
JOB_KEY_LEAST = 4


def url_job_key(url: Column) -> Column:
    """Key of a job address: the first rule that matches, else the last part of the path.

    Case is ignored in matching and kept in the result.  Blank and null give
    null; an address without a path is its own key.
    """
    ruled = [F.nullif(F.regexp_extract(url, f"(?iU){r}", re.compile(r).groups), F.lit("")) for r in JOB_KEY_RULES]
    after_scheme = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    path = F.regexp_replace(F.regexp_replace(after_scheme, r"^//[^/?#]*", ""), r"[?#].*$", "")
    # Parameters belong to the last part only.
    path = F.regexp_replace(path, r";[^/]*$", "")
    bare = F.rtrim(path, F.lit("/"))
    last = F.element_at(F.split(bare, "/"), -1)
    return F.when(F.coalesce(url, F.lit("")) == "", F.lit(None).cast("string")).otherwise(
        F.coalesce(*ruled, F.when(bare == "", url).otherwise(last))
    )


def url_match_keys(url: Column) -> Column:
    """Keys of which two addresses share one exactly if they match.

    Addresses match if they are equal but for closing slashes, or if their job
    keys are equal and long enough.  Blank addresses have no keys.
    """
    key = url_job_key(url)
    exact = F.concat(F.lit("u:"), F.rtrim(url, F.lit("/")))
    keyed = F.when(F.length(key) >= JOB_KEY_LEAST, F.concat(F.lit("i:"), key))
    return F.when(F.coalesce(url, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.array_compact(F.array(exact, keyed))
    )
