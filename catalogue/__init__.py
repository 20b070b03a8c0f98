"""Driver queries: each entry is a Spark query over the given tables and, where SQL can say it, its oracle."""

from catalogue import counts, membership, movement, reports, rules, storage, writers

ENTRIES = {
    **reports.ENTRIES, **rules.ENTRIES, **movement.ENTRIES, **storage.ENTRIES, **writers.ENTRIES, **counts.ENTRIES,
    **membership.ENTRIES,
}
