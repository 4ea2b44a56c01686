"""

``cleaning`` C1-C11/C18-C22/C33 · ``filters`` F1-F6, W1-W3 · ``aggregates`` A1-A25 ·
``joins`` J1-J10 · ``windows`` W4-W10 · ``sets`` U1-U4 · ``text`` T1-T16, A7 ·
``recommend`` R1-R8 · ``compete`` P1-P4 · ``trends`` X1-X7 · ``rating_model`` M1-M6 ·
``sinks`` K1-K12.
"""
