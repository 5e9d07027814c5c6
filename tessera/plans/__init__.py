"""Plans: fixture derivations from the test tables and the registered queries."""
