"""DataFrame -> DataFrame operators.

normalize   normalising projection, rating truncation, accent folding
snapshot    snapshot merge with change history; full / left / salted joins;
            change detection and history collection
quality     duplicate, null and type checks; valid / quarantine split;
            history normalise / explode / regroup; size profile
"""
