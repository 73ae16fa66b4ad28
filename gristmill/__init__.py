"""A content-intelligence engine for Spark: cleaning, deduplication, scoring, ledgers, synthesis and reporting."""
