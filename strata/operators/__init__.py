"""DataFrame operators: cleansing (P3), union (U1), routing (P4), aggregates (A1, A2, O1, O2),
and the distributed crawl-order sequence."""
