"""Jobs that combine operators: layers, training, optimisation and reports."""
