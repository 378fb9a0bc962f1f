"""DataFrame operators: keep-latest, merge, contract gate, layout, serving views."""
