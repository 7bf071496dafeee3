"""Where rows come from and where result rows go."""
