"""Column functions: null rules, predicates, text and distribution tails."""
