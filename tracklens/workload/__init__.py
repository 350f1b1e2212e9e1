"""The registered queries over the test tables, each with its SQL check where SQL can say it."""
