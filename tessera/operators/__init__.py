"""DataFrame -> DataFrame operators: conform, silver, gold, sequencing, quality."""
