"""Job specs and the runner that executes them in dependency order."""
