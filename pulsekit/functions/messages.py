"""Message texts of the rule tables."""

# Fixed values that must equal the reference: texts of messages and verdicts.
TEXT = {
    "keep_posting_consistently_your_data": 'Keep posting consistently — your data is still building and the models will improve each week',
    "content_is_gaining_momentum_on": '%s content is gaining momentum on %s — invest more in this format',
    "try_posting_times_per_week": 'Try posting %d times per week on %s (currently ~%d)',
    "schedule_your_most_important_post": 'Schedule your most important post for %d:00 KST',
    "create_more_content_on_it": "Create more %s content on %s — it's your top performer",
    "engagement_is_below_the_industry": '%s engagement is below the industry average — our content strategy on this platform needs a refresh',
    "we_re_getting_lots_of": "We're getting lots of likes but very few comments — try asking questions or creating discussion-worthy content",
    "our_audience_may_be_getting": 'Our audience may be getting tired of %s posts on %s (engagement is dropping)',
    "reach_has_been_declining_recently": '%s reach has been declining recently — try new content formats or increase posting frequency',
    "our_post_went_viral_on": 'Our post %s went viral on %s (%sx above average)',
    "using_emojis_increases_engagement_on": 'Using emojis increases engagement on %s',
    "multilingual_captions_korean_english_boost": 'Multilingual captions (Korean + English) boost engagement on %s',
    "is_our_best_performing_day": '%s is our best performing day',
    "posting_around_kst_gets_the": 'Posting around %d:00 KST gets the most engagement',
    "posts_on_get_the_best": '%s posts on %s get the best engagement (%d posts analyzed)',
    "reach_dropped_compared_to_last": '%s reach dropped %d%% compared to last week',
    "reach_grew_compared_to_last": '%s reach grew %d%% compared to last week',
    "we_gained_new_followers_across": 'We gained %s new followers across all platforms',
    "we_received_interactions_likes_comments": 'We received %s interactions (likes, comments, shares, saves)',
    "we_ve_published_posts_in": "We've published %s posts in total",
    "we_had_a_standout_post": ' We had a standout post that performed %sx above average!',
    "our_social_media_presence_is": "Our social media presence is steady. There's room to grow — the data shows a few opportunities we can take advantage of.",
    "there_are_some_areas_that": "There are some areas that need our attention. Engagement or reach is dropping on one or more platforms — let's adjust our approach.",
    "things_are_looking_great_our": 'Things are looking great! Our content is connecting with the audience and engagement is healthy across platforms.',
    "not_enough_data_for_deep": 'Not enough data for deep analysis yet. Keep adding weekly exports! At least 4 weeks of data is ideal.',
    "note_instagram_engagement_rate_uses": 'Note: Instagram engagement rate uses reach as denominator; TikTok uses views. Direct rate comparison between platforms should be interpreted with this in mind.',
    "viral_content_on_create_more": 'Viral content on %s: %s. Create more content in these formats.',
    "reach_is_growing_keep_up": '%s reach is growing! Keep up the momentum.',
    "reach_is_declining_consider_boosting": '%s reach is declining. Consider boosting posting frequency or trying new content formats on this platform.',
    "is_outperforming_industry_benchmark_by": '%s is outperforming industry benchmark by %s! Keep up the great work.',
    "engagement_is_below_industry_benchmark": '%s engagement is below industry benchmark. Review content strategy for this platform.',
    "comments_to_likes_ratio_is": 'Comments-to-likes ratio is low. Try asking questions, running polls, or creating discussion-worthy content.',
    "best_performing_day_is_consider": 'Best performing day is %s. Consider making this your primary posting day.',
    "not_enough_data_per_time": 'Not enough data per time slot to recommend posting hours yet. Keep adding weekly exports.',
    "hour_kst_shows_strong_engagement": 'Hour %d:00 KST shows strong engagement (%.0f posts). Consider posting around this time.',
    "your_best_posting_hour_is": 'Your best posting hour is %d:00 KST (based on %.0f posts). Schedule high-priority content around this time.',
    "on_your_best_content_type": "On %s, your best content type is '%s' with %s avg engagement (%d posts). Create more of this.",
    "warning_multiple_signals_declining_review": 'Warning — multiple signals declining, review content strategy',
    "low_momentum_engagement_or_reach": 'Low momentum — engagement or reach may be stalling',
    "moderate_momentum_stable_but_not": 'Moderate momentum — stable but not accelerating, consider experimenting',
    "good_momentum_steady_growth_look": 'Good momentum — steady growth, look for opportunities to push harder',
    "strong_momentum_your_content_strategy": 'Strong momentum — your content strategy is accelerating',
    "consider_posting_less_week_is": "Consider posting less: %d/week is optimal, you're averaging %d/week. Quality over quantity.",
    "consider_posting_more_week_is": "Consider posting more: %d/week is optimal, you're averaging %d/week.",
    "your_current_pace_week_is": 'Your current pace (~%d/week) is close to optimal (%d/week). Maintain it.',
}
