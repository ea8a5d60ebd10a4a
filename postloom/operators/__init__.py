"""DataFrame operators: keep-one, merge, seen links and reports."""
