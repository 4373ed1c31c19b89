"""Plans built from the operators: status report and stage timeline."""
