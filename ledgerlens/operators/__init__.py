"""DataFrame -> DataFrame operators: cleaning, vendor matching, EVM, star builders, reports, sizing."""
