"""The lead measures that attribution spreads."""

MEASURES = (
    "leads valid_leads qualified_leads offers orders booked_number completed_number potential_nmv gmv "
    "nmv booked_nmv completed_nmv uncancelled_nmv created_margin completed_margin uncancelled_margin"
).split()
