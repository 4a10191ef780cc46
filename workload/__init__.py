"""The library's operators applied to the star-schema test tables, with an SQL text for each."""
