"""Model plans: staging -> intermediate -> marts -> metrics/sheets/answers/contracts."""
